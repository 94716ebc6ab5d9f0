import numpy as np
from pyspark.sql import functions as F

from sensorlake.llm import quality
from tests.llm.nasty import document_frame, empty


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    found = quality.op3_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), "doc_id").toPandas()
    held = found[found.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.9 and found.score.between(0, 1).all()


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int").withColumn("text", F.lit("old"))


def test_odd_rows_have_scores(spark):
    docs = document_frame(spark)
    model = quality.train(docs, labels(spark, [(i, i % 2) for i in range(40)] + [(1000, 1), (1000, 0), (None, 1), (7, None), (99_999, 1)]))
    found = quality.score_quality(docs, model, "answer")
    assert found.columns == [*docs.columns, "answer"] and found.count() == docs.count()
    assert found.where("answer is null or answer < 0 or answer > 1").count() == 0


def test_no_labels_one_class_and_no_rows(spark):
    docs = document_frame(spark)
    for rows, want in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)):
        model = quality.train(docs, labels(spark, rows) if rows else empty(labels(spark, [(1, 1)])))
        assert {r["answer"] for r in quality.score_quality(docs, model, "answer").select("answer").collect()} == {want}
    none = empty(docs)
    assert quality.score_quality(none, quality.train(none, labels(spark, [(1, 1)])), "answer").count() == 0


def test_context_sums_are_those_of_all_neighbours(spark):
    texts = ["a b c a b", "c c", None, "a"]
    vocabulary = quality.Vocabulary(["a", "b", "c"])
    places, signs = quality.index_vectors(vocabulary.rows)
    want = np.zeros((vocabulary.rows, quality.DIM))
    for t in texts:
        ids = vocabulary.encode(t)
        for i, j in ((i, j) for i in range(len(ids)) for j in range(len(ids)) if 0 < abs(i - j) <= quality.REACH):
            for p, s in zip(places[ids[j]], signs[ids[j]]):
                want[ids[i], p] += s
    got = quality.context_sums(spark.createDataFrame([(t,) for t in texts], "text string"), ["a", "b", "c"])
    assert np.allclose(got, want)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))
    net = quality.Network().fit(x[:2000], y[:2000])
    p = net.probability(x[2000:])
    for low in (0.1, 0.4, 0.7):
        s = (p >= low) & (p < low + 0.2)
        assert abs(p[s].mean() - y[2000:][s].mean()) < 0.08


def test_plain_tokens_are_those_of_any_text():
    import random
    rng = random.Random(0)
    marks = [*map(chr, [9, 10, *range(0x20, 0x7F), *range(0xC0, 0x250)])]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(40)))
        assert quality.tokens(text) == quality.TOKEN.findall(text)


def plain_scores(texts, marks, k):
    """Scores of ``texts``, trained on the numbers in ``marks``, from loops over
    lists of tokens."""
    found = [quality.TOKEN.findall(t or "") for t in texts]
    n = {}
    for w in (w for t in found for w in t):
        n[w] = n.get(w, 0) + 1
    words = sorted(n, key=lambda w: (-n[w], w.encode()))[:k]
    vocabulary = quality.Vocabulary(words)
    places, signs = quality.index_vectors(vocabulary.rows)
    own, context = np.zeros((vocabulary.rows, quality.DIM)), np.zeros((vocabulary.rows, quality.DIM))
    for r in range(vocabulary.rows):
        for p, s in zip(places[r], signs[r]):
            own[r, p] += s
    rows = [vocabulary.encode(t) for t in texts]
    for ids in rows:
        for i in range(len(ids)):
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if i != j:
                    context[ids[i]] += own[ids[j]]
    length = np.sqrt((context ** 2).sum(axis=1))
    vectors = np.hstack([context / np.where(length > 0, length, 1)[:, None], own / 2])
    out = []
    for t, words_of, ids in zip(texts, found, rows):
        if not words_of:
            out.append(np.zeros(4 * quality.DIM + 8))
            continue
        x, m = vectors[ids], len(words_of)
        letters = sum(w.isalpha() for w in words_of)
        capitals = sum(w.isalpha() and len(w) > 1 and w.isupper() for w in words_of)
        shouted = sum(len(w) > 1 and w.isupper() for w in words_of)
        assert shouted == capitals
        lines = t.split("\n")
        out.append(np.concatenate([x.mean(axis=0), x.std(axis=0), [
            np.log1p(m), len(set(words_of)) / m, capitals / max(letters, 1), letters / m, words_of.count("\n") / m,
            len(set(lines)) / len(lines), max(words_of.count(w) for w in set(words_of)) / m, min(1, 50 / m)]]))
    x = np.array(out)
    at = sorted(marks)
    net = quality.Network().fit(x[at], np.array([marks[i] > 0 for i in at]))
    return net.probability(x)


def test_scores_are_those_of_a_plain_version(spark):
    d = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").select("doc_id", "text").limit(240).toPandas()
    texts = [*frame.text, None, "", "\n\n", "ÀÉ é 12 ²½ ... \t!", "x" * 5000, "Same same SAME\nSame same SAME"]
    marks = {i: i % 3 % 2 for i in range(200)}
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = quality.train(docs, labels(spark, list(marks.items())), words=300)
    got = {r["doc_id"]: r["answer"] for r in quality.score_quality(docs, model, "answer").select("doc_id", "answer").collect()}
    coded = {r["doc_id"]: r["score"] for r in quality.score_coded(quality.tokenised(docs), model).collect()}
    want = plain_scores(texts, marks, 300)
    assert len(got) == len(coded) == len(texts)
    assert max(abs(got[i] - coded[i]) for i in got) < 1e-9
    assert max(abs(got[i] - want[i]) for i in got) < 0.02


def test_rows_and_pieces_of_tokens(spark, monkeypatch):
    texts = ["a b c a b \n a", None, "", "c c", "b " * 30]
    docs = spark.createDataFrame([(None if i == 3 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    assert sorted(r["lines"] for r in quality.tokenised(docs).collect()) == [1, 1, 1, 1, 2]
    assert quality.frequent_words(quality.tokenised(docs), 2) == ["b", "a"]
    whole = quality.context_sums(docs, ["a", "b", "c"])
    monkeypatch.setattr(quality, "PIECE", 3)
    assert np.allclose(quality.neighbour_sums(quality.tokenised(docs), ["a", "b", "c"]), whole)

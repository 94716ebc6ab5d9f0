import random
from collections import defaultdict

import pytest

from sensorlake.llm import mixing
from tests.llm.nasty import document_frame, documents, empty


def size(text):
    return len((text or "").encode().split())


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = left / (sum(w[s] for s in order if s not in capped) or 1)
        new = {s for s in order if s not in capped and w[s] * share > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in capped else w[s] * share for s in order}
        capped |= new


def check(spark, rows, near=0.02):
    docs = document_frame(spark, rows)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size(t)
    targets = plain_targets(sizes)
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sorted(((r["doc_id"], r["size"]) for r in found), key=str) == sorted(((i, size(t)) for i, t, *_ in rows), key=str)
    for s, t in targets.items():
        assert taken[s] == pytest.approx(t, rel=near, abs=20)
    return found


def test_sizes_targets_and_taken(spark):
    check(spark, documents())


def test_small_sources_are_capped_and_the_rest_shared_again(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randrange(1, 30)), None, s) for i, s in enumerate(["a"] * 3 + ["b"] * 60 + ["c"] * 200 + [None] * 2 + ["d"] * 30)]
    check(spark, rows)


def test_reruns_agree_however_rows_are_dealt(spark):
    docs = document_frame(spark)
    one, two = (sorted((tuple(r) for r in mixing.mix(d).select("doc_id", "size", "taken").collect()), key=str) for d in (docs, docs.repartition(7).orderBy("text")))
    assert one == two


def test_one_source_no_words_and_no_rows(spark):
    check(spark, [(1, "a b c", None, "x"), (2, "d", None, "x")], near=0.5)
    found = mixing.mix(document_frame(spark, [(1, "", None, "x"), (2, None, None, None)])).collect()
    assert [(r["size"], r["taken"]) for r in found] == [(0, 0), (0, 0)]
    assert mixing.mix(empty(document_frame(spark))).count() == 0
    assert mixing.mixed_documents(empty(document_frame(spark))).count() == 0


def test_documents_are_repeated_as_often_as_they_are_taken(spark):
    rows = [(i, f"u{i} " * 20, None, "abc"[i % 3]) for i in range(300)]
    docs = document_frame(spark, rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["source"]] += size(r["text"])
    for s, t in plain_targets({"a": 2000, "b": 2000, "c": 2000}).items():
        assert words[s] == pytest.approx(t, abs=60)


def test_plans_hold_no_python(spark):
    text = mixing.mix(document_frame(spark))._jdf.queryExecution().toString() + mixing.mixed_documents(document_frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


@pytest.mark.parametrize("sources,words", [(0, 0), (1, 5), (3, 10**9), (20, 10**13), (7, 10**15), (5_000_000, 10**15), (50, 10**17)])
def test_any_corpus_fits_the_integers_of_the_schedule(sources, words):
    block, least = mixing.block_lengths(sources, words)
    uses = 3 * (words / block + sources * (least + 1))
    assert block >= 1 and least >= 1 and uses * mixing.STEP < 1 << 63
    if 3 * words < mixing.USES * mixing.BLOCK and sources < 80_000:
        assert block <= mixing.BLOCK and least == mixing.SLOTS


def test_slots_of_many_large_sources(spark):
    sizes = [(f"s{i}", i, 10**12 * (1 + i % 7)) for i in range(40)]
    targets = spark.createDataFrame(sizes, "source string, source_no long, source_size long").withColumn("target", mixing.F.col("source_size") * 1.5)
    words = sum(x[2] for x in sizes)
    targets = mixing.cut_targets(targets, words // 60_000)
    slots = round(targets.agg(mixing.F.sum("shares")).first()[0])
    scratch = mixing.Scratch(spark, "slots")
    uses = {r["source_no"]: r["n"] for r in mixing.schedule(targets, slots, 3, scratch).groupBy("source_no").agg(mixing.F.sum("uses").alias("n")).collect()}
    assert sum(uses.values()) == slots
    for r in targets.collect():
        assert uses[r["source_no"]] == pytest.approx(r["shares"], abs=8)


def test_small_sources_beside_large_ones(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 16)  # blocks as long, for their sources, as those of far larger tables
    monkeypatch.setattr(mixing, "FEW", 8)
    small = [(n, f"s{n}") for n in (3, 7, 30, 60, 150, 300, 500, 1000)]
    rows = [(i, "w " * n, None, s) for i, (n, s) in enumerate(small)]
    rows += [(100 + i, "w " * 500, None, "abcd"[i % 4]) for i in range(400)]
    found = mixing.mix(document_frame(spark, rows)).collect()
    taken = {r["source"]: r["taken"] for r in found if r["source"].startswith("s")}
    for n, s in small:
        assert taken[s] == pytest.approx(3 * n, rel=0.1), s
    assert {r["doc_id"] for r in mixing.mixed_documents(document_frame(spark, rows)).where("source like 's%'").collect()} == set(range(8))

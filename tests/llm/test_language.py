from pyspark.sql import functions as F

from sensorlake.llm import language
from tests.llm.nasty import document_frame, empty

EN = "the cat and the dog were walking with the bird through the garden"
DE = "der hund und die katze gehen mit dem vogel durch den garten spazieren"


def test_held_out_languages(spark):
    d = "/root/testdata/sf0.01"
    found = language.op4_langid(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98 and found.score.between(0, 1).all()


def test_words_first_then_shorter_grams():
    model = language.Model(["a", "b"], [0.0, 0.0], {"cat": (2.0, -2.0)}, [{"x": (-1.0, 1.0)}, {"ca": (9.0, -9.0)}, {"qat": (-3.0, 3.0)}])
    assert model.word("cat") == (2.0, -2.0)
    assert model.word("qat") == (-3.0, 3.0)
    assert model.word("cab") == (9.0, -9.0)
    assert model.word("x") == (-1.0, 1.0)
    assert model.word("öö") == (0.0, 0.0)


def test_texts_without_letters_and_clashing_columns(spark):
    docs = document_frame(spark)
    train = spark.createDataFrame([(EN, "en"), (DE, "de"), (None, "en"), (EN, None)], "text string, lang string")
    found = language.identify(docs, language.train(train), "answer")
    assert found.columns == [*docs.columns, "answer"] and found.count() == docs.count()
    for r in found.select("text", "answer.*").collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de") and 0 <= r["score"] <= 1


def test_empty_tables(spark):
    none = empty(document_frame(spark))
    model = language.train(none)
    assert model.langs == []
    assert language.identify(none, model, "answer").count() == 0
    assert [r["answer"]["lang_pred"] for r in language.identify(document_frame(spark), model, "answer").limit(3).collect()] == ["und"] * 3


def test_filter_keeps_columns_and_clear_texts(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de", "s") for i in range(40)] + [(99, "12 34", "en", "s"), (98, None, None, None)]
    docs = document_frame(spark, rows)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))


def test_counts_cover_whole_texts(spark):
    rows = spark.createDataFrame([("a " * 5000 + "b", "x"), ("b b", "x"), ("b", "y")], "text string, lang string")
    counts = {(r["lang"], r["word"]): r["n"] for r in language.word_counts(rows).collect()}
    assert counts == {("x", "a"): 5000, ("x", "b"): 3, ("y", "b"): 1}
    most = language.top(spark.createDataFrame([("x", w, 1) for w in "dcba"], "lang string, word string, n long"), ["lang"], "word", 2)
    assert sorted(r["word"] for r in most.select(F.col("word")).collect()) == ["a", "b"]


def test_words_that_occur_once_teach_ngrams(spark):
    train = spark.createDataFrame([("the cat the cat the dog the dog", "en"), ("perro gato casas mesas", "es")], "text string, lang string")
    model = language.train(train)
    assert "rro" in model.grams[2]
    assert model.predict("perros")[0] == "es" and model.predict("gatos perra")[0] == "es"


def test_number_signs_are_no_letters(spark):
    model = language.train(document_frame(spark))
    for text in ("\u00bd", "12 \u00b2 3", "\u2460", "\u2167", "_ 7"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("\u00bd x")[0] != "und"


def test_nothing_is_dropped_without_a_label(spark):
    docs = document_frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language.keep_identified(docs).count() == docs.count()


def test_most_frequent_by_histograms(spark):
    import random
    rng = random.Random(2)
    rows = sorted({(g, "".join(rng.choice("ab\u00e9") for _ in range(rng.randrange(1, 6)))): rng.choice([1, 1, 1, 2, 3, 50]) for g in "xyz" for _ in range(150)}.items())
    rows = [(g, w, n) for (g, w), n in rows] + [("few", "a", 1)]
    df = spark.createDataFrame(rows, "g string, w string, n long")
    for k in (1, 7, 40, 90, 1000):
        want = [r for g in ("x", "y", "z", "few") for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1].encode()))[:k]]
        assert sorted(tuple(r) for r in language.top(df, ["g"], "w", k).collect()) == sorted(want)


def test_plans_of_the_selection_stay_small(spark):
    """Counts were worked out anew for each histogram and each part of the
    result, in plans of some fifty exchanges."""
    counts = language.word_counts(spark.createDataFrame([(EN, "en"), (DE, "de")], "text string, lang string"))
    plan = language.top(counts, ["lang"], "word", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 1 and plan.count("Exchange hashpartitioning") <= 2, plan

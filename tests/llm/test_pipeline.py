import corpus_pipeline
from sensorlake.llm.common import Scratch
from tests.llm.nasty import document_frame, documents, empty
from tests.llm.test_decontaminate import ITEMS, plain
from tests.llm.test_simhash import plain_components


def test_stages_in_turn(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [r for r in documents() if len(r[1] or "") < 5000] + [(3000 + i, "before it " + t + " behind it", "en", "a") for i, t in ITEMS[:5]]
    docs, scratch, seen = document_frame(spark, rows), Scratch(spark, "test"), []
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.stage(stage(spark, docs, str(tmp_path)), name)
        seen.append((docs, out))
        if name != "tokens":
            assert out.columns == docs.columns
        docs = out
    value = lambda df: [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.select("doc_id", "text", "lang", "source").collect()]
    known, one, clean, mixed = (value(b) for _, b in seen[:4])
    assert all(any(c.isalpha() for c in t) for _, t, *_ in known) and len(known) > 90
    groups = {c for *_, c in plain_components([r for r in known if r[0] is not None])}
    assert {r[0] for r in one if r[0] is not None} == groups
    assert sorted(map(str, clean)) == sorted(str(r) for r in one if not any(plain(r[1], x) for _, x in ITEMS))
    assert set(map(str, mixed)) <= set(map(str, clean))
    assert docs.count() == len(mixed)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty(document_frame(spark, clashing=False)).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_whole_table(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 50

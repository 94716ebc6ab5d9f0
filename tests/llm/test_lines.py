import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorlake.llm import lines
from tests.llm.nasty import document_frame, documents, empty

SPACES = " \t\n\x0b\x0c\r"


def plain_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain(rows, least_docs=10, least_chars=1, keep_first=False):
    """Brute force: (doc_id, text, lines, dropped, kept text) of each row."""
    of = defaultdict(set)
    split = [(t or "").split("\n") for _, t, *_ in rows]
    for r, text in enumerate(split):
        for x in text:
            if len(plain_key(x)) >= least_chars:
                of[plain_key(x)].add(r)
    common = {k for k, v in of.items() if len(v) >= least_docs}
    out = []
    for (doc_id, text, *_), found in zip(rows, split):
        drop = {i for i, x in enumerate(found) if plain_key(x) in common}
        out.append((doc_id, len(found), len(drop), "\n".join(x for i, x in enumerate(found) if i not in drop)))
    return out


def rows():
    rng = random.Random(4)
    common = ["Terms of use", "  terms OF use\t", "É", "é", "x", "Cookie policy \x0b", "日本 　", "日本", " x", "x\r"]
    out = documents()
    for i in range(300):
        out.append((5000 + i, "\n".join(rng.choice([*common, f"line {rng.randrange(400)}", "", " "]) for _ in range(rng.randrange(1, 12))), "en", "a"))
    out += [(6000, "\n".join(["only here, often"] * 5000), "en", "a"), (6001, "a\n" * 20_000, "en", "a"), (6002, "\n\n", None, None)]
    out += [(7000, "the same row\nTERMS of use", "en", "a")] * 12  # repeated rows are documents
    return out


@pytest.mark.parametrize("tasks", [4, 61])
def test_as_brute_force(spark, tasks):
    """With many tasks the common lines go on over many of them."""
    data = rows()
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = document_frame(spark, data)
        found = lines.with_bitmaps(docs, lines.line_bitmaps(docs), "keep bits").select("doc_id", "text", "keep bits").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [(r[0], *lines.kept_lines(r[1].encode() if r[1] is not None else None, r[2])) for r in found]
    want = [(i, n, d, t.encode()) for i, n, d, t in plain(data)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sum(n for _, _, n, _ in want) > 500


def test_least_length_and_texts(spark):
    data = rows()
    docs = document_frame(spark, data)
    out = lines.dedup_lines(docs, least_docs=5, least_chars=2)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"] or "") for r in out.select("doc_id", "text").collect()]
    assert sorted(map(str, got)) == sorted(str((i, t)) for i, _, _, t in plain(data, 5, 2))
    assert out.where("text is null").count() == sum(t is None for _, t, *_ in data)


@pytest.mark.parametrize("tasks", [3, 40])
def test_first_occurrence_stays(spark, tasks):
    data = [(i, f"own {i}\nshared\n  SHARED ", "en", "a") for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(document_frame(spark, data, clashing=False), keep_first=True).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: f"own {i}" + ("\nshared" if i == 0 else "") for i in range(500)}


def test_bitmaps():
    import numpy as np
    for places in ([0], [7], [8], [0, 3, 90_000], list(range(0, 5000, 2))):
        assert lines.dropped_places(lines.packed_bits(np.array(places))) == set(places)
    assert lines.dropped_places(None) == set()


def test_no_documents_and_query(spark):
    assert lines.line_bitmaps(empty(document_frame(spark))).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain([tuple(r) for r in docs])]
    got = lines.op11_lines(spark, "/root/testdata/sf0.001")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert got.agg(F.sum("n_dropped")).first()[0] > 0

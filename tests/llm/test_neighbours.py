import numpy as np
from pyspark.sql import functions as F

from sensorlake.llm import neighbours
from tests.llm.nasty import empty


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", *[F.lit("old").alias(c) for c in ("id", "v", "node", "near", "d", "label", "q", "h")])


def usable(rows):
    ok = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    lengths = [len(v) for _, v in ok]
    most = max(set(lengths), key=lambda n: (lengths.count(n), -n)) if ok else 0
    return {(i, tuple(np.float32(v).astype(float))) for i, v in ok if len(v) == most}


def exact(rows, query, k=10):
    good = usable(rows)
    out = {}
    for q, x in good:
        if query(q):
            d = sorted((np.sqrt(((np.array(x) - np.array(y)) ** 2).sum()), i) for i, y in good if i != q)
            out[q] = d[:k]
    return out


def run(spark, rows, modulo):
    found = neighbours.search_table(frame(spark, rows), F.col("vec_id") % modulo == 0).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_table(spark):
    d = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    want, got = exact(rows, lambda i: i % 100 == 0), run(spark, rows, 100)
    assert want.keys() == got.keys()
    assert sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_odd_vectors_copies_and_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    same = rng.normal(size=6).tolist()
    rows += [(400 + i, same) for i in range(60)] + [(900, None), (901, []), (902, [0.0] * 6), (903, [float("nan")] * 6), (904, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (905, [float("inf")] + [1.0] * 5),
                                                    (906, [1.0, 2.0]), (None, same), (10, rows[10][1]), (400, same)]
    want, got = exact(rows, lambda i: i % 20 == 0), run(spark, rows, 20)
    assert want.keys() == got.keys()
    hit = 0
    for q in want:
        assert [s for s, _ in got[q]] == sorted(s for s, _ in got[q]) and q not in {i for _, i in got[q]}
        hit += len({i for _, i in want[q]} & {i for _, i in got[q]})
        if 400 <= q < 460:
            assert got[q] == want[q]
    assert hit >= 0.9 * 10 * len(want)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (20, [3.0, 4.0])]
    got = run(spark, rows, 20)
    assert {q: [i for _, i in x] for q, x in got.items()} == {0: [1, 2, 20], 20: [1, 2, 0]}
    assert run(spark, [(0, [1.0])], 20) == {}
    assert neighbours.search_table(empty(frame(spark, rows)), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_where_three_rounds_are_too_few(spark):
    x = np.random.default_rng(5).normal(size=(8000, 64)).astype(np.float32)
    got = run(spark, list(enumerate(x.tolist())), 80)
    d = lambda q: np.where(np.arange(len(x)) == q, np.inf, ((x - x[q]) ** 2).sum(1))
    assert len(got) == 100
    assert sum(len({i for _, i in got[q]} & set(np.argsort(d(q))[:10].tolist())) for q in got) >= 0.95 * 10 * len(got)


def test_every_copy_starts_at_its_own_vector(spark):
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(200, 16)) * 100, 15, 0) + rng.normal(size=(3000, 16)) * 0.01
    x = np.concatenate([x, x]).astype(np.float32)
    got = run(spark, list(enumerate(x.tolist())), 61)
    assert len(got) == 99
    assert all(s[0] == (0.0, (q + 3000) % 6000) for q, s in got.items())

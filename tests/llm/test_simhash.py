import itertools

import numpy as np
import pytest
import xxhash

from sensorlake.llm import simhash
from sensorlake.llm.common import Scratch
from tests.llm.nasty import document_frame, documents, empty


def plain_fingerprint(text):
    w = (text or "").encode()
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in w).split()
    if not w:
        return 0
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, distance=2):
    fps = {plain_fingerprint(t) for _, t, *_ in rows}
    parent = {x: x for x in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= distance:
            parent[root(a)] = root(b)
    least = {}
    for i, t, *_ in rows:
        r = root(plain_fingerprint(t))
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, plain_fingerprint(t), least[root(plain_fingerprint(t))]) for i, t, *_ in rows), key=str)


def test_matches_brute_force(spark):
    rows = documents()
    found = simhash.simhash_components(document_frame(spark)).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found), key=str) == plain_components(rows)


def test_empty_table(spark):
    assert simhash.simhash_components(empty(document_frame(spark))).count() == 0
    assert simhash.keep_one(empty(document_frame(spark))).count() == 0


def test_keeps_one_of_each_component(spark):
    docs = document_frame(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    groups = {}
    for i, fp, c in plain_components(documents()):
        groups.setdefault((c, fp if c is None else None), []).append(i)
    assert len(got) == len(groups)
    assert sorted(x for x in got if x is not None) == sorted(c for c, _ in groups if c is not None)


def test_bands_find_every_link():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for n in (10, 10**6, 10**12):
        masks = simhash.bands(n, 2)
        for bits in itertools.combinations(range(0, 64, 5), 2):
            y = x ^ np.uint64(sum(1 << b for b in bits))
            same = [(simhash.coordinates(x) & m) == (simhash.coordinates(y) & m) for m in masks]
            assert np.any(same, axis=0).all()


def test_pivot_distances_bound_the_distance():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    apart = np.abs(simhash.pivot_distances(x) - simhash.pivot_distances(y)).max(axis=1)
    assert (apart <= np.bitwise_count(x ^ y)).all()


@pytest.mark.parametrize("cell", [1, 8, 4096])
def test_large_cells_have_an_exact_way(spark, cell, monkeypatch):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 1 << 62))
    fps = {base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))} | {int(v) for v in rng.integers(0, 1 << 62, 200)}
    monkeypatch.setattr(simhash, "CELL", cell)
    nodes = spark.createDataFrame([(v,) for v in fps], "fp long")
    scratch = Scratch(spark, "test")
    labels = {r["node"]: r["label"] for r in simhash.connected_components(simhash.links(nodes, len(fps), 2, scratch), scratch).collect()}
    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= 2:
            assert labels[a] == labels[b]


def test_long_chains_are_one_component(spark):
    from sensorlake.llm.components import connected_components
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    labels = {r["node"]: r["label"] for r in connected_components(edges, Scratch(spark, "test")).collect()}
    assert set(labels.values()) == {0, 500} and len(labels) == 203

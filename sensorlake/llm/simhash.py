"""SimHash near-duplicates, found with tables of distances to pivots."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, beside, free_name, if_small, parts, same, small_batches, sorted_blocks, starts, table
from sensorlake.llm.components import connected_components

BITS = 64
SEED = 42
#: The reference fingerprints: zero, and one for each pair of adjacent bits.
PIVOTS = np.array([0, *(3 << (2 * i) for i in range(BITS // 2))], dtype=np.uint64)
#: A cell with more distinct fingerprints is linked by masks, not by pairs.
CELL = 4096


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash over the word shingles of a whole text; 0 without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    joined, size = b" ".join(w), min(words, len(w))
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(first[:len(w) - size + 1].tolist(), ends[size - 1:].tolist())
    ones, n = np.zeros(BITS, np.int64), 0
    while block := [digest(joined[a:b], SEED) for a, b in itertools.islice(spans, 8192)]:
        bits = np.unpackbits(np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(block)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_hash and signed fp of every row."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, words) for x in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp.view(np.int64))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def pivot_distances(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int16)


def coordinates(fp: np.ndarray) -> np.ndarray:
    """The pivot distances without what they share: d(x, 0) and d(x, pair i)
    give the number of ones in pair i, packed at two bits a pair."""
    d = pivot_distances(fp)
    ones = ((d[:, :1] + 2 - d[:, 1:]) // 2).astype(np.uint64)
    return (ones << (2 * np.arange(BITS // 2, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def bands(n: int, distance: int) -> list[np.uint64]:
    """Masks over the packed coordinates. ``distance`` differing bits change at
    most that many of the 32 coordinates, so of g bands all but ``distance``
    are equal: one mask keeps each choice of g - distance bands. g grows with
    the number of fingerprints until a kept choice (about 1.5 bits a
    coordinate) tells them apart; every g finds every link."""
    pairs = BITS // 2
    need = math.log2(max(n, 2)) + 2
    g = next((g for g in range(distance + 2, pairs) if 1.5 * pairs * (g - distance) / g >= need), distance + 8)
    edges = [round(i * pairs / g) for i in range(g + 1)]
    band = [sum(3 << (2 * i) for i in range(a, b)) for a, b in itertools.pairwise(edges)]
    return [np.uint64(sum(c)) for c in itertools.combinations(band, g - distance)]


def close_pairs(fp: np.ndarray, first: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within the runs of ``fp`` that begin at ``first``. Small
    runs give their linked pairs, longer ones one link to a smaller member of
    the same linked set, which has as few links as members."""
    ends = np.append(first[1:], len(fp))
    run = np.repeat(np.arange(len(first)), ends - first)
    size = (ends - first)[run]
    out_a, out_b = [], []
    d = pivot_distances(fp)
    small = 24
    for step in range(1, min(small, int(size.max(initial=1)))):
        i = np.flatnonzero((run[step:] == run[:-step]) & (size[step:] <= small))
        i = i[np.abs(d[i] - d[i + step]).max(axis=1, initial=0) <= distance]
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= distance]
        out_a.append(fp[i])
        out_b.append(fp[i + step])
    for a, b in zip(first.tolist(), ends.tolist()):
        if b - a > small:
            x, dx = fp[a:b], d[a:b]
            label = np.arange(b - a)
            while True:
                new = label.copy()
                for at in range(0, b - a, 256):
                    far = np.zeros((min(256, b - a - at), b - a), bool)
                    for p in range(0, dx.shape[1], 8):
                        far |= np.abs(dx[at:at + 256, None, p] - dx[None, :, p]) > distance
                    near = ~far & (np.bitwise_count(x[at:at + 256, None] ^ x[None, :]) <= distance)
                    new[at:at + 256] = np.where(near, label[None, :], b - a).min(axis=1)
                new = new[new]
                if (new == label).all():
                    break
                label = new
            off = np.flatnonzero(label != np.arange(b - a))
            out_a.append(x[off])
            out_b.append(x[label[off]])
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def links(nodes: DataFrame, n: int, distance: int, scratch: Scratch) -> DataFrame:
    """(a, b): links that join all distinct fingerprints within ``distance``
    bits of each other into the same component."""
    masks = bands(n, distance)
    out = pa.schema([("band", pa.int32()), ("cell", pa.int64()), ("fp", pa.int64())])

    def cells(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            c = coordinates(fp)
            for k, m in enumerate(masks):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array((c & m).view(np.int64)), pa.array(fp.view(np.int64))], schema=out)

    pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(batches):
        for t in sorted_blocks(batches, ["band", "cell"]):
            fp = t.column("fp").to_numpy().view(np.uint64)
            a, b = close_pairs(fp, starts(t, ["band", "cell"]), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=pair)

    dealt = scratch.stage(nodes.select("fp").mapInArrow(cells, "band int, cell long, fp long"), "cells")
    large = scratch.stage(dealt.groupBy("band", "cell").count().where(F.col("count") > CELL).select("band", "cell"), "large-cells")
    rest = dealt
    many = large.count()
    if many:
        rest = dealt.join(if_small(large), ["band", "cell"], "left_anti")
    found = (rest.repartition(parts(nodes.sparkSession), "band", "cell").sortWithinPartitions("band", "cell")
             .mapInArrow(linked, "a long, b long"))
    if many:
        found = found.union(masked(dealt.join(if_small(large), ["band", "cell"], "left_semi").select("fp").distinct(), distance))
    return scratch.stage(found.distinct(), "near")


def masked(nodes: DataFrame, distance: int) -> DataFrame:
    """The exact way for large cells: fingerprints that agree on all but
    ``distance`` bits share a masked value, and all that share it are within
    ``distance`` bits; each links to the least of them."""
    holes = [sum(1 << i for i in c) for c in itertools.combinations(range(BITS), distance)]
    out = pa.schema([("hole", pa.int32()), ("rest", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k, h in enumerate(holes):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array((fp & ~np.uint64(h)).view(np.int64)), pa.array(fp.view(np.int64))], schema=out)

    keys = nodes.mapInArrow(run, "hole int, rest long, fp long")
    least = keys.groupBy("hole", "rest").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keys.join(least, ["hole", "rest"]).where("fp <> b").select(F.col("fp").alias("a"), "b")


def simhash_components(docs: DataFrame, words: int = 3, distance: int = 2, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, text_hash, fp, label (one fingerprint of the component) and
    component_id of every row of ``docs``.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is
    the smallest doc_id reachable. Fingerprints are compared once each, however
    many documents share one. Null or wordless texts have fingerprint zero;
    null ids are no component's smallest unless it has no other (then null);
    repeated rows all stay; an empty table gives no row; columns other than
    doc_id and text are not read.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "simhash")
    rows = scratch.stage(fingerprints(docs, words), "fingerprints")
    nodes = scratch.stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    near = links(nodes, nodes.count(), distance, scratch)
    labels = connected_components(near, scratch).withColumnRenamed("node", "fp")
    linked = scratch.stage(nodes.join(labels, "fp").groupBy("label").agg(F.min("least").alias("component_id")), "linked")
    members = labels.join(linked, "label").select("fp", "label", "component_id")
    classes = scratch.stage(nodes.join(members, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), F.coalesce("component_id", "least").alias("component_id")), "classes")
    return rows.join(classes, "fp").select("doc_id", "text_hash", "fp", "label", "component_id")


def keep_one(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component: its smallest doc_id, of equal
    ids that with the smaller text hash; of rows equal in both, one."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash-keep")
    found = scratch.stage(simhash_components(docs, words, distance, scratch), "components")
    id_key = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash")
    best = scratch.stage(found.groupBy("label").agg(F.min(id_key).alias("best"), F.count("*").alias("n")).where("n > 1")
                         .select("label", "best"), "best")
    lost = (found.join(best, "label")
            .where(~same(F.col("best.doc_id"), F.col("doc_id")) | (F.col("best.text_hash") != F.col("text_hash")))
            .select(F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash")).distinct())
    lost, (lost_id, lost_hash) = beside(docs, scratch.stage(lost, "lost"))
    again, (again_id, again_hash) = beside(docs, scratch.stage(found.groupBy("doc_id", "text_hash").count().where("count > 1").drop("count"), "again"))
    mark = free_name(docs, "mark")
    rows = docs.withColumn(mark, F.xxhash64("text"))
    kept = rows.join(if_small(lost), same(lost_id, rows["doc_id"].cast("long")) & (lost_hash == rows[mark]), "left_anti")
    if again.limit(1).count():
        twice = if_small(again)
        on = same(again_id, F.col("doc_id").cast("long")) & (again_hash == F.col(mark))
        once = kept.join(twice, on, "left_anti")
        kept = once.union(kept.join(twice, on, "left_semi").dropDuplicates(["doc_id", mark]))
    return kept.drop(mark)


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Removal of long byte strings that occur more than once, by bucket-pointer
refinement on the starts that matter.

A suffix array would sort every start of the corpus. To know which strings of
LENGTH bytes repeat, it is enough to sort a few starts of each such string, if
equal strings choose equal ones: those whose GRAM bytes have the least hash
among all grams of some string (anchors). The refinement is that of a
bucket-pointer sort:

1. anchors fall into buckets by their first GRAM bytes; buckets of one are done;
2. a bucket is refined by the identifiers of the bytes around it, as far as
   any string over the anchor reaches: of equal ones all strings repeat;
3. what is left are members whose surroundings differ from others in their
   bucket. Their buckets are refined by identifiers of the LENGTH bytes at each
   offset around the anchor. A bucket is compared in one task up to MEMBERS
   members; the strings of larger ones are dealt by their identifiers instead.

Identifiers are worked out by doubling: one of 2n bytes is made of those of n
bytes at two offsets, and used for the next.
"""

import functools
import gc
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, parts, small_batches, sorted_blocks, starts, table

LENGTH = 200
GRAM = 50
#: Grams of one string, and the bytes that a string reaches beyond a gram in it.
GRAMS = LENGTH - GRAM + 1
REACH = LENGTH - GRAM
#: Members of a bucket that one task compares, in some 60 MB.
MEMBERS = 8192
#: Bytes that are hashed at once.
PIECE = 1 << 20


def random_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


TABLES = [random_table(11), random_table(12)]
#: Factors of each doubling. They differ, or bytes at places with as many ones
#: in their number could change places unseen.
FACTORS = np.random.default_rng(13).integers(1, 1 << 63, (16, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def identifiers(data: np.ndarray, n: int, of: int = 0) -> np.ndarray:
    """A 64-bit identifier of the n bytes from each place on, by doubling."""
    x, k, level = TABLES[of][data], 1, 0
    while 2 * k <= n:
        x = x[:-k] * FACTORS[level, 0] + x[k:] * FACTORS[level, 1]
        k, level = 2 * k, level + 1
    if k < n:
        x = x[:len(x) - (n - k)] * FACTORS[level, 0] + x[n - k:] * FACTORS[level, 1]
    for shift, factor in ((31, FACTORS[-1, 0]), (29, FACTORS[-1, 1]), (32, None)):
        x ^= x >> np.uint64(shift)
        if factor is not None:
            x *= factor
    return x


def sliding(x: np.ndarray, n: int, least: bool) -> np.ndarray:
    """The least or the greatest of n values from each place on."""
    f, k = np.minimum if least else np.maximum, 1
    while 2 * k <= n:
        x = f(x[:-k], x[k:])
        k *= 2
    return f(x[:len(x) - (n - k)], x[n - k:]) if k < n else x


def pieces(texts: list[bytes]):
    """Chunks of about PIECE bytes: lists of (row, offset, bytes) that hold
    every string of every text once; long texts are cut with an overlap."""
    held, size = [], 0
    for row, t in enumerate(texts):
        for at in range(0, len(t) - LENGTH + 1, PIECE):
            held.append((row, at, t[at:at + PIECE + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors(texts: list[bytes]):
    """(row, place, identifier) arrays of the anchors of each chunk."""
    for chunk in pieces(texts):
        data = np.frombuffer(b"".join(c[2] for c in chunk), np.uint8)
        sizes = np.array([len(c[2]) for c in chunk])
        first = np.cumsum(sizes) - sizes
        g = identifiers(data, GRAM)
        m = sliding(g, GRAMS, True)
        # strings do not cross texts
        inside = np.zeros(len(m) + 1, np.int32)
        np.add.at(inside, first, 1)
        np.add.at(inside, np.minimum(first + sizes - LENGTH + 1, len(m)), -1)
        m = np.where(np.cumsum(inside[:-1]) > 0, m, np.uint64(0))
        pad = np.zeros(REACH, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate([pad, m, pad]), GRAMS, False) == g)
        which = np.searchsorted(first, at, side="right") - 1
        rows, offsets = np.array([c[0] for c in chunk]), np.array([c[1] for c in chunk])
        yield rows[which], at - first[which] + offsets[which], g[at].view(np.int64)


def surroundings(t: bytes, at: int) -> int:
    """The identifier of all bytes of strings over the gram at ``at``, and of
    how far they reach to the left."""
    left = min(REACH, at)
    return int.from_bytes(hashlib.blake2b(t[at - left:at + GRAM + REACH], digest_size=8, salt=left.to_bytes(2, "little")).digest(), "little", signed=True)


def reach(at: int, n: int) -> tuple[int, int]:
    """From and to: the bytes of strings over the gram at ``at``."""
    return max(0, at - REACH), min(n, at + GRAM + REACH)


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Texts:
    """The corpus as a table bucketed by row number, so that what is found for
    a row meets its text again without a shuffle of the texts."""

    def __init__(self, docs: DataFrame, scratch: Scratch):
        spark, self.n = docs.sparkSession, parts(docs.sparkSession)
        small_batches(spark)
        self.spark, path = spark, scratch.path("texts")
        self.name = "texts_" + path.split("/")[-2].replace("-", "_")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
        rows = rows.withColumn("row", F.monotonically_increasing_id()).repartition(self.n, "row")
        rows.write.bucketBy(self.n, "row").option("compression", "zstd").option("path", path).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def meet(self, side: DataFrame, how: str) -> DataFrame:
        return self.rows().join(side.hint("shuffle_hash"), "row", how)


def repeated_spans(texts: Texts, scratch: Scratch) -> DataFrame:
    """(row, spans): of each row with any, its repeated strings. A span is the
    first and last start of a run, or an anchor (last null) over which all
    strings repeat."""
    spark = texts.spark

    def count(batches):
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])
        for b in batches:
            found = [x[2] for x in anchors(b.column("text").to_pylist())]
            if found:
                ids, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], schema=schema)

    def place(batches):
        schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("at", pa.int32())])
        for b in batches:
            numbers = b.column("row").to_numpy()
            for row, at, ids in anchors(b.column("text").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(numbers[row]), pa.array(at.astype(np.int32))], schema=schema)

    # 1: buckets of the first bytes
    many = scratch.stage(texts.rows().select("text").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).where("n > 1").select("id"), "buckets")
    release(spark)
    members = texts.rows().select("row", "text").mapInArrow(place, "id long, row long, at int").join(many, "id", "left_semi")
    members = scratch.stage(members, "members")
    scratch.drop(many)
    release(spark)
    found = members.groupBy("row").agg(F.collect_set(F.struct("at", "id")).alias("found"))

    # 2: refined by what is around
    def refine(batches):
        schema = pa.schema([("id", pa.int64()), ("around", pa.int64()), ("row", pa.int64()), ("at", pa.int32())])
        for b in batches:
            out = ([], [], [], [])
            for row, t, found in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), b.column("found").to_pylist()):
                for x in found:
                    for c, v in zip(out, (x["id"], surroundings(t, x["at"]), row, x["at"])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    refined = scratch.stage(texts.meet(found, "inner").select("row", "text", "found").mapInArrow(refine, "id long, around long, row long, at int"), "refined")
    scratch.drop(members)
    release(spark)
    classes = scratch.stage(refined.groupBy("id", "around").agg(F.count("*").alias("n"), F.min(F.struct("row", "at")).alias("one")), "classes")
    mixed = classes.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id", (F.col("k") > MEMBERS).alias("large"))
    mixed = scratch.stage(mixed, "mixed")
    whole = refined.join(scratch.stage(classes.where("n > 1").select("id", "around"), "whole"), ["id", "around"], "left_semi")
    spans = [whole.select("row", F.col("at").alias("first"), F.lit(None).cast("int").alias("last"))]
    left = scratch.stage(classes.join(mixed, "id").select("id", "one.row", "one.at", "large"), "left")

    # 3: refined at each offset
    def contexts(batches):
        schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("context", pa.binary())])
        for b in batches:
            out = ([], [], [], [])
            for row, t, found in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), b.column("found").to_pylist()):
                for x in found:
                    a, z = reach(x["at"], len(t))
                    for c, v in zip(out, (x["id"], row, x["at"], t[a:z])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    def compare(batches):
        for t in sorted_blocks(batches, ["id"], 4000):
            yield repeated_starts(t)

    def by_row(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row").agg(F.collect_list(F.struct("at", "id")).alias("found"))

    near = texts.meet(by_row(left.where("not large")), "inner").select("row", "text", "found").mapInArrow(contexts, "id long, row long, at int, context binary")
    near = near.repartition(texts.n, "id").sortWithinPartitions("id")
    spans.append(near.mapInArrow(compare, "row long, first int, last int"))

    def strings(batches):
        schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("row", pa.int64()), ("start", pa.int32())])
        for b in batches:
            for row, t, found in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), b.column("found").to_pylist()):
                for a, z in union([reach(x["at"], len(t)) for x in found]):
                    for part in range(a, z - LENGTH + 1, PIECE):
                        data = np.frombuffer(t, np.uint8)[part:min(z, part + PIECE + LENGTH - 1)]
                        h = [identifiers(data, LENGTH, k).view(np.int64) for k in (0, 1)]
                        n = len(h[0])
                        yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), pa.array(np.full(n, row)), pa.array(np.arange(part, part + n, dtype=np.int32))], schema=schema)

    if left.where("large").limit(1).count():
        every = scratch.stage(texts.meet(by_row(left.where("large")), "inner").select("row", "text", "found").mapInArrow(strings, "h1 long, h2 long, row long, start int"), "strings")
        twice = scratch.stage(every.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"), "twice")
        spans.append(every.join(twice, ["h1", "h2"], "left_semi").select("row", F.col("start").alias("first"), F.col("start").alias("last")))
    found = functools.reduce(DataFrame.union, spans)
    found = scratch.stage(found.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")
    scratch.drop(refined, classes, mixed, left)
    release(spark)
    return found


def repeated_starts(t: pa.Table) -> pa.RecordBatch:
    """(row, first, last): runs of starts in whole buckets (id, row, at,
    context) whose strings another member of the bucket has at the same offset
    from its anchor."""
    contexts, at = t.column("context").to_pylist(), t.column("at").to_numpy()
    size = np.array([len(c) for c in contexts])
    h = identifiers(np.frombuffer(b"".join(contexts), np.uint8), LENGTH)
    n = size - LENGTH + 1
    member = np.repeat(np.arange(len(size)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = np.cumsum(size) - size
    bucket = np.zeros(len(size), np.uint64)
    bucket[starts(t, ["id"])[1:]] = 1
    key = h[first[member] + offset]
    left = np.minimum(at, REACH)
    key ^= np.cumsum(bucket)[member] * FACTORS[-2, 0]
    key += (offset - left[member]).astype(np.uint64) * FACTORS[-2, 1]
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    hit = times[which] > 1
    edge = np.zeros(len(hit), bool)
    edge[np.cumsum(n) - n] = True
    begins = hit & (edge | ~np.concatenate([[False], hit[:-1]]))
    ends = hit & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([hit[1:], [False]]))
    a, z = np.flatnonzero(begins), np.flatnonzero(ends)
    base = at - left
    rows = t.column("row").to_numpy()
    return pa.RecordBatch.from_arrays([pa.array(rows[member[a]]), pa.array((base[member[a]] + offset[a]).astype(np.int32)), pa.array((base[member[z]] + offset[z]).astype(np.int32))], names=["row", "first", "last"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of
    ``docs`` (doc_id, text), with the kept bytes as ``kept``.

    Every byte is removed that is covered by a string of 200 bytes which also
    starts anywhere else in the table, in the same text or in another one, as
    the texts are before any removal; n_spans counts the maximal removed runs.
    Null texts are empty; texts under 200 bytes are kept whole; repeated rows
    are texts of their own, so that both lose what they share; null doc_ids
    stay; an empty table gives no row; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = Texts(docs, scratch)
    release(texts.spark)
    found = repeated_spans(texts, scratch)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                t = r["text"]
                spans = union([reach(x["first"], len(t)) if x["last"] is None else (x["first"], x["last"] + LENGTH) for x in r["spans"] or []])
                edges = [0, *itertools.chain.from_iterable(spans), len(t)]
                kept = b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2]))
                rows.append({"doc_id": r["doc_id"], "n_bytes": len(t), "n_removed": len(t) - len(kept), "n_spans": len(spans), "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    whole = texts.meet(found, "left").select("doc_id", "text", "spans")
    return whole.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")

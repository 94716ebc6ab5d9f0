"""Line deduplication: lines are dealt out by their hash, and what comes back
for each document is a bitmap of the lines it keeps, not its text.

Rows (hash, document, position) are range-partitioned by all of these, so a
line that a third of all documents hold is spread over as many tasks as it
fills. A task streams its rows in that order: the first row of a hash is the
line's first occurrence, and rows are told as soon as enough documents have
been seen. Only the first and the last hash of a task may go on in another
one; their counts are added up in a table of at most two rows a task.
"""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, beside, free_name, same, small_batches, starts, table
from sensorlake.operators.joins import bounded_broadcast

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of bitmaps that are broadcast at most; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20

LINE = "high long, low long, doc_id long, text_hash long, pos int, first boolean"
TOLD = "kind int, high long, low long, doc_id long, text_hash long, pos int, n long"
#: Kinds of told rows: a line that drops, one whose hash goes on in another
#: task, and the first of such a hash, with the documents counted here.
DROP, OPEN, LEAD = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """A line without space at its ends, A-Z lower-cased."""
    return line.strip(SPACES).lower()


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """A row for each line with a key of ``least_chars`` code points or more:
    its 128-bit hash, its document and place, and whether it is the document's
    first line of that key."""
    schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()), ("first", pa.bool_())])

    def run(batches):
        for b in batches:
            digests, ids, texts, places, firsts = [], [], [], [], []

            def rows():
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                return pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(places, pa.int32()), pa.array(firsts, pa.bool_())], schema=schema)

            for doc_id, text_hash, text in zip(b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist(), b.column("text").to_pylist()):
                seen = set()
                for i, line in enumerate((text or b"").split(b"\n")):
                    key = line_key(line)
                    if not key or least_chars > 1 and len(key.decode()) < least_chars:
                        continue
                    digest = xxhash.xxh3_128_digest(key)
                    digests.append(digest)
                    ids.append(doc_id)
                    texts.append(text_hash)
                    places.append(i)
                    firsts.append(digest not in seen)
                    seen.add(digest)
                if len(digests) > 100_000:
                    yield rows()
                    digests, ids, texts, places, firsts = [], [], [], [], []
            yield rows()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, LINE)


class Run:
    """The rows of one hash as a task streams them. It holds rows back only
    until ``least`` documents are counted, so at most those of fewer."""

    def __init__(self, key: tuple, opens: bool, least: int, keep_first: bool):
        self.key, self.opens, self.least, self.keep_first = key, opens, least, keep_first
        self.n, self.lead, self.held = 0, None, []

    def add(self, t: pa.Table) -> None:
        self.n += int(np.count_nonzero(t.column("first").to_numpy()))
        if self.lead is None:
            self.lead, t = t.slice(0, 1), t.slice(1)
        if t.num_rows:
            self.held.append(t)

    def told(self) -> list[tuple[int, int, pa.Table]]:
        """What is certain already: (kind, documents, rows)."""
        if self.n < self.least:
            return []
        out, self.held = [(DROP, 0, t) for t in self.held], []
        return out

    def close(self, ends: bool) -> list[tuple[int, int, pa.Table]]:
        """The rest, at the hash's last row here; ``ends`` at the task's."""
        out = self.told()
        if self.opens or ends:
            return out + [(OPEN, 0, t) for t in self.held] + [(LEAD, self.n, self.lead)]
        if self.n >= self.least and not self.keep_first:
            out.append((DROP, 0, self.lead))
        return out


def settled(least: int, keep_first: bool):
    """Streams a task's sorted rows into told ones."""
    schema = pa.schema([("kind", pa.int32()), ("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()), ("n", pa.int64())])

    def told(found):
        for kind, n, t in found:
            for x in t.to_batches():
                size = x.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), *(x.column(c) for c in ("high", "low", "doc_id", "text_hash", "pos")), pa.array(np.full(size, n, np.int64))], schema=schema)

    def run(batches):
        open_ = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            at = starts(t, ["high", "low"])
            ends = np.append(at[1:], t.num_rows)
            high, low = t.column("high").to_numpy(), t.column("low").to_numpy()
            key = lambda i: (high[at[i]], low[at[i]])
            i = 0
            if open_ is None:
                open_ = Run(key(0), True, least, keep_first)
            if open_.key == key(0):
                open_.add(t.slice(0, ends[0]))
                yield from told(open_.told())
                i = 1
            if i == len(at):
                continue
            yield from told(open_.close(False))
            last = len(at) - 1
            if i < last:  # whole hashes, all at once
                a, z = at[i], at[last]
                n = np.add.reduceat(t.column("first").to_numpy()[a:z].astype(np.int64), at[i:last] - a)
                drop = np.repeat(n >= least, ends[i:last] - at[i:last])
                if keep_first:
                    drop[at[i:last] - a] = False
                yield from told([(DROP, 0, t.slice(a, z - a).filter(pa.array(drop)))])
            open_ = Run(key(last), False, least, keep_first)
            open_.add(t.slice(at[last]))
            yield from told(open_.told())
        if open_:
            yield from told(open_.close(True))

    return run


def dropped_lines(docs: DataFrame, scratch: Scratch, least_docs: int, least_chars: int, keep_first: bool) -> DataFrame:
    """(doc_id, text_hash, pos) of the lines that drop."""
    order = ["high", "low", "doc_id", "text_hash", "pos"]
    lines = scratch.stage(line_hashes(docs, least_chars), "lines")
    told = lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(settled(least_docs, keep_first), TOLD)
    told = scratch.stage(told, "told")
    scratch.drop(lines)
    place = F.struct(F.col("doc_id").isNotNull(), "doc_id", "text_hash", "pos")
    leads = told.where(F.col("kind") == LEAD)
    total = leads.groupBy("high", "low").agg(F.sum("n").alias("total"), F.min(place).alias("least")).where(F.col("total") >= least_docs)
    open_ = told.where(F.col("kind") != DROP).join(total, ["high", "low"])
    if keep_first:
        open_ = open_.where(~((F.col("kind") == LEAD) & (place == F.col("least"))))
    at = ["doc_id", "text_hash", "pos"]
    return told.where(F.col("kind") == DROP).select(*at).unionAll(open_.select(*at))


def packed_bits(drop: np.ndarray) -> bytes:
    """A keep bitmap up to the last line that drops: bit i of byte i // 8 is 0
    if line i drops, and lines beyond its end stay. Raw behind a zero byte, or
    deflated behind a one where that is shorter."""
    bits = np.ones((int(drop[-1]) // 8 + 1) * 8, np.uint8)
    bits[drop] = 0
    raw = np.packbits(bits, bitorder="little").tobytes()
    small = zlib.compress(raw, 9)
    return b"\1" + small if len(small) < len(raw) else b"\0" + raw


def dropped_places(keep: bytes | None) -> set[int]:
    """The line numbers that a keep bitmap drops; none if there is no bitmap."""
    if keep is None:
        return set()
    raw = zlib.decompress(keep[1:]) if keep[:1] == b"\1" else keep[1:]
    return set(np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little") == 0).tolist())


def line_bitmaps(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), n_dropped and keep (see
    ``packed_bits``) of each document that loses a line.

    Lines are split at \\n; a line's key is the line without space at both
    ends, A-Z lower-cased, compared by its 128-bit hash. A key of
    ``least_chars`` code points or more that ``least_docs`` documents hold
    loses all its lines, or with ``keep_first`` all but the first in order of
    doc_id (null first), text hash and place.

    Every row is a document, repeated rows too: each counts, and those equal in
    id and text share one bitmap. Null and empty texts are one empty line,
    which has no key; null ids are documents like others; an empty table gives
    no row; columns other than doc_id and text are not read.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_dropped", pa.int32()), ("keep", pa.binary())])

    def run(batches):
        held, key = [], None

        def bitmap():
            drop = np.unique(np.concatenate(held))
            return {"doc_id": key[0], "text_hash": key[1], "n_dropped": len(drop), "keep": packed_bits(drop)}

        for b in batches:
            if not b.num_rows:
                continue
            ids, texts, pos = b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist(), b.column("pos").to_numpy()
            text = np.array(texts)
            number = np.array([x or 0 for x in ids])
            null = np.array([x is None for x in ids])
            at = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (number[1:] != number[:-1]) | (null[1:] != null[:-1])]))
            out = []
            for a, z in zip(at.tolist(), np.append(at[1:], b.num_rows).tolist()):
                if held and key != (ids[a], texts[a]):
                    out.append(bitmap())
                    held = []
                key = (ids[a], texts[a])
                held.append(pos[a:z])
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([bitmap()], schema=schema)

    dropped = dropped_lines(docs, scratch, least_docs, least_chars, keep_first)
    dealt = dropped.repartition("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    return scratch.stage(dealt.mapInArrow(run, "doc_id long, text_hash long, n_dropped int, keep binary"), "bitmaps")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, keep: str) -> DataFrame:
    """``docs`` with a column ``keep``: the bitmap, null where no line drops.
    Bitmaps within the byte bound are broadcast, more are joined by a shuffle."""
    mark = free_name(docs, "mark")
    side, (doc_id, text_hash, bits) = beside(docs, bitmaps.select("doc_id", "text_hash", "keep"))
    rows = docs.withColumn(mark, F.xxhash64("text"))
    on = same(rows["doc_id"].cast("long"), doc_id) & (rows[mark] == text_hash)
    return rows.join(bounded_broadcast(side, max_bytes=BROADCAST_BYTES), on, "left").select(*[docs[c] for c in docs.columns], bits.alias(keep))


def kept_lines(text: bytes | None, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and the text that stays."""
    lines = (text or b"").split(b"\n")
    drop = dropped_places(keep)
    return len(lines), len(drop), b"\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text or b""


def dedup_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``docs`` with the lines of ``line_bitmaps`` taken out of ``text``. Rows
    that lose no line stay as they are, null texts too."""
    keep = free_name(docs, "keep")

    @F.pandas_udf("string")
    def cut(text: pd.Series, bits: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else kept_lines(t.encode(), b)[2].decode() for t, b in zip(text, bits)], dtype=object)

    rows = with_bitmaps(docs, line_bitmaps(docs, least_docs, least_chars, keep_first), keep)
    text = F.when(F.col(keep).isNull(), F.col("text")).otherwise(cut(F.when(F.col(keep).isNotNull(), F.col("text")), F.col(keep)))
    return rows.withColumn("text", text).drop(keep)


def op11_lines(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for b in batches:
            found = [kept_lines(t, k) for t, k in zip(b.column("text").to_pylist(), b.column("keep").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                                              pa.array([hashlib.sha256(x[2]).hexdigest() for x in found], pa.string())], schema=schema)

    rows = with_bitmaps(docs, line_bitmaps(docs), "keep").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), "keep")
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


OP11_SQL = r"""
WITH l AS (
  SELECT r, doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.r
"""

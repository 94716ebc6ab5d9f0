"""WARC archives: a deterministic sharded writer and its reader.

Records are sorted by page, url, digest; each is a gzip member of its own. A
file is a run of the sorted records: where each file ends follows from the
running total of compressed bytes over all records, so the files are the same
however the work is dealt out.
"""

import gzip
import hashlib
import io
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import Commit, Scratch, filesystem, parts, small_batches, table
from sensorlake.operators.joins import bounded_broadcast

#: Compressed bytes of a file.
ROLL_BYTES = 32 << 20
#: Payloads from this size on are stored once.
LEAST_SHARED = 100
LEVEL = 6
#: Tasks that write or read files at most; beyond, neighbouring files share one.
TASKS = 20_000
#: Records carry no clock time, or two runs would differ.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "file string, file_no long, records long, bytes long, sha256 string"


def head(fields: list[tuple[str, str]]) -> bytes:
    """WARC header lines; line ends within a value are percent-encoded."""
    lines = [f"{k}: {v.replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A') if k in ('WARC-Target-URI', 'WARC-Refers-To-Target-URI') else v}" for k, v in fields]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def unescape(v: str) -> str:
    return v.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def member(data: bytes) -> bytes:
    """One gzip member, without a time or a name in its header."""
    out = io.BytesIO()
    with gzip.GzipFile(filename="", mode="wb", compresslevel=LEVEL, fileobj=out, mtime=0) as f:
        f.write(data)
    return out.getvalue()


def http_head(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def record_id(*key) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, repr(key))}>"


def record(page_id: int | None, url: str | None, digest: str, n: int, payload: bytes | None, refers: tuple | None = None) -> bytes:
    """A response with its payload, or a revisit that refers to (page_id, url)
    of one. Headers and block digest are made anew for each."""
    block = http_head(n) + (payload or b"")
    fields = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(page_id, url, digest, bool(refers))), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(n))]
    if refers:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*refers, digest, False)), ("WARC-Refers-To-Date", DATE)]
        if refers[1] is not None:
            fields.append(("WARC-Refers-To-Target-URI", refers[1]))
        if refers[0] is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers[0])))
    fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return member(head(fields) + block + b"\r\n\r\n")


def read_records(f):
    """(headers, block) of each record of an open archive, one at a time."""
    with gzip.GzipFile(fileobj=f) as z:
        while line := z.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError("not a WARC record")
            headers = {}
            while (line := z.readline()) != b"\r\n":
                if not line:
                    raise ValueError("the archive ends within a header")
                k, _, v = line.decode().rstrip("\r\n").partition(": ")
                headers[k] = v
            n = int(headers["Content-Length"])
            block = z.read(n)
            if len(block) < n or z.read(4) != b"\r\n\r\n":
                raise ValueError("the archive ends within a record")
            yield headers, block


def packed_pages(pages: DataFrame, with_bytes: bool) -> DataFrame:
    """Every row's digest and lengths as the response record it may become,
    with the record itself or without. Packing is deterministic, so records are
    made twice and never staged: for their sizes, and to be written."""
    small_batches(pages.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("n", pa.int64()), ("packed", pa.binary()), ("size", pa.int64())])

    def run(batches):
        for b in batches:
            rows = []
            for page_id, url, html in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                packed = record(page_id, url, digest, len(payload), payload)
                rows.append((page_id, url, digest, len(payload), packed if with_bytes else None, len(packed)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)] if rows else [pa.array([], t.type) for t in schema], schema=schema)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, digest string, n long, packed binary, size long")


#: Rows equal in all of these are the same record and may change places.
ORDER = ["page_null", "page_id", "url_null", "url", "digest"]


def ordered(rows: DataFrame) -> DataFrame:
    """Null pages and urls last; none of the sort columns is null."""
    return rows.select("*", F.col("page_id").isNull().alias("page_null"), F.col("url").isNull().alias("url_null"))


def decisions(sizes: DataFrame, scratch: Scratch, roll_bytes: int) -> tuple[DataFrame, list]:
    """What each shared payload's rows refer to (small columns only), and the
    first sort key of each file but the first.

    The response of a payload is its first row in sort order; of equal rows one
    is, the others refer to it. The running total of record sizes is kept as a
    sum per range of rows and one within the range; equal rows are one entry,
    so a range never splits them."""
    spark = sizes.sparkSession
    key = F.struct(F.col("page_id").isNull().alias("page_null"), "page_id", F.col("url").isNull().alias("url_null"), "url")
    meta = sizes.groupBy("page_id", "url", "digest").agg(F.first("n").alias("n"), F.first("size").alias("size"), F.count("*").alias("times"))
    first = meta.groupBy("digest", "n").agg(F.min(key).alias("first"), F.sum("times").alias("copies"))
    first = first.where((F.col("copies") > 1) & (F.col("n") >= LEAST_SHARED)).select("digest", F.struct("first.page_id", "first.url").alias("refers"))
    meta = meta.join(bounded_broadcast(scratch.stage(first, "responses")), "digest", "left")
    is_first = F.col("refers.page_id").eqNullSafe(F.col("page_id")) & F.col("refers.url").eqNullSafe(F.col("url"))
    # a revisit has a header only; its size counts as this much
    revisit = F.lit(500) + F.length(F.coalesce("url", F.lit("")))
    responses = F.when(F.col("refers").isNull(), F.col("times")).when(is_first, F.lit(1)).otherwise(F.lit(0))
    meta = meta.withColumn("size", responses * F.col("size") + (F.col("times") - responses) * revisit)
    meta = scratch.stage(ordered(meta.select("page_id", "url", "digest", "size", "refers", is_first.alias("is_first"))), "decisions")
    told = meta.where("refers is not null")
    total = meta.agg(F.sum("size")).first()[0] or 0
    if total <= roll_bytes:
        return told, []
    ranged = scratch.stage(meta.select(*ORDER, "size").repartitionByRange(parts(spark), *ORDER).withColumn("range", F.spark_partition_id()), "ranges")
    sums = {r["range"]: r["size"] for r in ranged.groupBy("range").agg(F.sum("size").alias("size")).collect()}
    upto, before = 0, []
    for k in sorted(sums):  # a number for each range
        before.append((k, upto))
        upto += sums[k]
    offsets = F.broadcast(spark.createDataFrame(before, "range int, before long"))
    inside = F.sum("size").over(Window.partitionBy("range").orderBy(*ORDER)) - F.col("size")
    at = ranged.join(offsets, "range").withColumn("file_no", F.floor((F.col("before") + inside) / roll_bytes))
    cuts = at.where("file_no > 0").groupBy("file_no").agg(F.min(F.struct(*ORDER)).alias("k")).orderBy("file_no").select("k").collect()
    return told, [tuple(r["k"]) for r in cuts]  # a key for each file


def below(a: tuple, b: tuple) -> bool:
    """Whether sort key a is before b; nulls only stand where both have one."""
    for x, y in zip(a, b):
        if x != y:
            return y is None if x is None or y is None else x < y
    return False


def file_of(key: tuple, cuts: list) -> int:
    low, high = 0, len(cuts)
    while low < high:
        mid = (low + high) // 2
        if below(key, cuts[mid]):
            high = mid
        else:
            low = mid + 1
    return low


def write_warc(pages: DataFrame, folder: str, scratch: Scratch, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; returns the manifest,
    which is written beside them and alone says which files count.

    Each file is dealt to a task of its own (several neighbouring files share
    one beyond TASKS of them), which writes it under a temporary name and moves
    it to its own name when whole, so a task that runs twice leaves the same
    files. A null html is an empty payload; null urls and page_ids have no
    header and sort last; repeated rows are records of their own; an empty
    table writes no file.
    """
    spark = pages.sparkSession
    sizes = scratch.stage(packed_pages(pages, False).drop("packed"), "sizes")
    known, cuts = decisions(sizes, scratch, roll_bytes)
    # decisions travel as rows of their own, just before what they decide on
    told = known.select(*ORDER, "refers", "is_first", F.lit(0).alias("kind"))
    rows = ordered(packed_pages(pages, True)).select(*ORDER, F.lit(1).alias("kind"), "packed", "n")
    shared = spark.sparkContext.broadcast(cuts)

    @F.pandas_udf("long")
    def file_number(page_null: pd.Series, page_id: pd.Series, url_null: pd.Series, url: pd.Series, digest: pd.Series) -> pd.Series:
        ids = (None if z else int(x) for z, x in zip(page_null, page_id))
        return pd.Series([file_of(k, shared.value) for k in zip(page_null, ids, url_null, url, digest)], dtype="int64")

    schema = pa.schema([("file", pa.string()), ("file_no", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def run(batches):
        out, row, refers = None, None, None

        def done():
            out.close()
            return pa.RecordBatch.from_pylist([row | {"bytes": out.size, "sha256": row["sha256"].hexdigest()}], schema=schema)

        for b in batches:
            for r in b.to_pylist():
                if row and row["file_no"] != r["file_no"]:
                    yield done()
                    row = None
                key = tuple(r[c] for c in ORDER)
                if r["kind"] == 0:
                    refers = [key, r["refers"], r["is_first"]]
                    continue
                if not row:
                    name = f"pages-{r['file_no']:08d}.warc.gz"
                    out, row = Commit(folder, name), {"file": name, "file_no": r["file_no"], "records": 0, "sha256": hashlib.sha256()}
                to = refers[1] if refers and refers[0] == key else None
                if to and refers[2]:
                    to, refers[2] = None, False  # the first of these rows is the response
                data = record(r["page_id"], r["url"], r["digest"], r["n"], None, (to["page_id"], to["url"])) if to else r["packed"]
                out.write(data)
                row["sha256"].update(data)
                row["records"] += 1
        if row:
            yield done()

    dealt = rows.unionByName(told, allowMissingColumns=True).withColumn("file_no", file_number(*ORDER) if cuts else F.lit(0).cast("long"))
    files = len(cuts) + 1
    tasks = min(files, TASKS)
    dealt = dealt.repartitionById(tasks, F.expr(f"cast(file_no * {tasks} div {files} as int)")).sortWithinPartitions("file_no", *ORDER, "kind")
    path = f"{folder}/manifest"
    dealt.mapInArrow(run, MANIFEST).write.parquet(path)
    scratch.drop(sizes)
    return spark.read.schema(MANIFEST).parquet(path)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and
    payload (null for revisits) of every record of the manifest's files. Each
    response's payload and each block is checked against its digest."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file", "file_no")
    count = max(1, files.count())
    tasks = min(count, TASKS)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def rows(name):
        fs, root = filesystem(folder)
        with fs.open_input_file(f"{root}/{name}") as f:
            for h, block in read_records(f):
                if h["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                    raise ValueError(f"{name}: a block is not what its digest says")
                digest, kind = h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"]
                payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{name}: a payload is not what its digest says")
                number = lambda k: int(h[k]) if k in h else None
                yield {"page_id": number("X-Page-ID"), "url": unescape(h["WARC-Target-URI"]) if "WARC-Target-URI" in h else None, "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": digest, "record_type": kind, "refers_to": number("X-Refers-To-Page-ID"), "payload": payload}

    def run(batches):
        for b in batches:
            for name in b.column("file").to_pylist():
                held, size = [], 0
                for r in rows(name):
                    held.append(r)
                    size += len(r["payload"] or b"") + 200
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    out = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return files.repartitionById(tasks, F.expr(f"cast(file_no * {tasks} div {count} as int)")).mapInArrow(run, out)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    folder = scratch.path("files")
    write_warc(table(spark, sf_dir, "pages"), folder, scratch)
    return read_warc(spark, folder).drop("payload", "url")


OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_page FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
  CASE WHEN f.first_page <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first_page <> p.page_id THEN f.first_page END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND p.payload_bytes >= 100
"""

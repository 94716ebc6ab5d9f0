import hashlib
import os

from pyspark.sql import functions as F

from sensorlake.llm import warc
from sensorlake.llm.common import Scratch, filesystem
from tests.llm.nasty import CLASHING, empty

BIG, OTHER, SMALL = "<p>" + "x" * 200, "<p>é" * 60, "<p>small"


def pages():
    rows = [(5, "http://a/1", BIG), (3, "http://a/2", BIG), (9, "http://b/ü\r\nX: y%0A", BIG), (1, "u", SMALL), (2, "v", SMALL), (4, None, None), (6, "w", ""),
            (7, "x", OTHER), (None, "n", BIG), (8, "http://c", "<a>" + "z" * 3_000_000), (10, "y", "\r\n\r\nWARC/1.1\r\n" * 20)]
    rows += [(100 + i, f"http://h/{i}", OTHER) for i in range(40)]
    return rows + [(3, "http://a/2", BIG), (3, "http://a/0", BIG), (None, None, None)]


def frame(spark):
    return spark.createDataFrame(pages(), "page_id long, url string, html string").select("*", *[F.lit(1).alias(c) for c in CLASHING + ["payload", "row", "range"]if c != "row"])


def written(spark, roll=warc.ROLL_BYTES):
    scratch = Scratch(spark, "test")
    folder = scratch.path("files")
    warc.write_warc(frame(spark), folder, scratch, roll)
    return folder


def test_round_trip_and_revisits(spark):
    found = warc.read_warc(spark, written(spark)).collect()
    rows = pages()
    assert len(found) == len(rows)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is None, rows[i][1] or ""))
    first, want = {}, []
    for i in order:
        page, url, html = rows[i]
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        kind, to = "response", None
        if len(data) >= 100:
            if digest in first:
                kind, to = "revisit", first[digest]
            first.setdefault(digest, page)
        want.append((page, url, len(data), digest, kind, to, data if kind == "response" else None))
    got = [(r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"]) if r["payload"] is not None else None) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_files_are_sorted_rolled_and_the_same_again(spark):
    folders = [written(spark, 1000) for _ in range(2)]
    names = [sorted(x for x in os.listdir(filesystem(f)[1]) if x.endswith(".gz")) for f in folders]
    assert names[0] == names[1] and len(names[0]) > 5
    ids = []
    for name in names[0]:
        one, two = (open(f"{filesystem(f)[1]}/{name}", "rb").read() for f in folders)
        assert one == two
        with open(f"{filesystem(folders[0])[1]}/{name}", "rb") as f:
            ids += [h.get("X-Page-ID") for h, _ in warc.read_records(f)]
    numbers = [int(x) for x in ids if x]
    assert numbers == sorted(numbers) and ids[len(numbers):] == [None] * (len(ids) - len(numbers)) and len(ids) == len(pages())
    manifest = spark.read.parquet(f"{folders[0]}/manifest").collect()
    assert {r["file"]: r["sha256"] for r in manifest} == {n: hashlib.sha256(open(f"{filesystem(folders[0])[1]}/{n}", "rb").read()).hexdigest() for n in names[0]}


def test_empty_table(spark):
    scratch = Scratch(spark, "test")
    folder = scratch.path("files")
    warc.write_warc(empty(frame(spark)), folder, scratch)
    assert warc.read_warc(spark, folder).count() == 0

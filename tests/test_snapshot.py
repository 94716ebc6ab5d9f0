"""JSON arrays split over tasks (own values)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sensorlake.operators.silver import build_silver
from sensorlake.schemas import BRONZE
from sensorlake.session import scratch_path
from sensorlake.sources.snapshot import land_arrays, read_array, read_snapshot
from tests.test_scale_plans import _plan

ODD = ['plain', 'a "quoted" word', 'brace } in text', '}{][', 'ends with \\', '\\" and \\\\', '', 'é 日本 \U0001F600', 'line\nbreak', '"', '}"}', '\\}', '{"a": [1, {"b": "}"}]}']


def entry(i):
    return {"id": i, "timestamp": ODD[i % len(ODD)], "sensor": {"id": i * 3, "sensor_type": {"name": ODD[(i * 7) % len(ODD)]}} if i % 5 else None,
            "location": {"latitude": "1.5", "longitude": "2", "country": ODD[(i * 3) % len(ODD)]},
            "sensordatavalues": [{"value_type": ODD[(i + j) % len(ODD)], "value": "}" * j, "extra": {"deep": [[], [{}]]}} for j in range(i % 4)]}


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.fixture
def splits_of(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


@pytest.mark.parametrize("size", [97, 1000, 1 << 27])
def test_split_arrays_hold_the_entries_of_whole_ones(spark, splits_of, size, tmp_path):
    path = str(tmp_path / "arrays")
    write(path, "a.json", json.dumps([entry(i) for i in range(60)]))
    write(path, "b.json", json.dumps([entry(i) for i in range(100, 140)], indent=3, ensure_ascii=False))
    write(path, "c.json", "\n".join(["[", ",\r\n".join(json.dumps(entry(i), separators=(",", ":")) for i in range(200, 220)), "]", ""]))
    write(path, "none.json", " [ ] ")
    write(path, "empty.json", "")
    splits_of(size)
    if size < 2000:
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 3
    got = sorted(str(r.asDict(True)) for r in read_array(spark, path).collect())
    want = sorted(str(r.asDict(True)) for r in read_snapshot(spark, path, multiline=True).where("id is not null").collect())
    assert got == want and len(got) == 120


def test_what_breaks_off_or_fits_no_schema(spark, splits_of, tmp_path):
    path = str(tmp_path / "broken")
    whole = [json.dumps(entry(i)) for i in range(3)]
    write(path, "cut.json", "[" + ",".join(whole) + ', {"id": 9, "timestamp": "x"')
    write(path, "odd.json", '[{"id": "no number"}, {}, {"id": 77, "other": {"id": 1}}]')
    splits_of(64)
    assert sorted((r["id"] for r in read_array(spark, path).collect()), key=str) == [0, 1, 2, 77, None, None]


def test_landed_arrays(spark, splits_of, tmp_path):
    rows = spark.range(500).select(F.col("id"), F.concat(F.lit("t}"), F.col("id").cast("string")).alias("timestamp"))
    path = land_arrays(rows, str(tmp_path / "landed"), entries=200)
    splits_of(300)
    assert sorted((r["id"], r["timestamp"]) for r in read_array(spark, path).collect()) == [(i, f"t}}{i}") for i in range(500)]
    assert read_snapshot(spark, path, multiline=True).count() == 500
    assert land_arrays(rows.limit(0), str(tmp_path / "nothing"))


def test_checks_without_a_parse_reach_the_scan(spark):
    path = scratch_path(spark, "bronze_scan")
    spark.createDataFrame([], BRONZE).write.parquet(path)
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    try:
        plan = _plan(build_silver(spark.read.schema(BRONZE).parquet(path)))
    finally:
        spark.conf.set(key, before)
    pushed = next(x for x in plan.splitlines() if "PushedFilters" in x).split("PushedFilters")[1]
    assert "IsNotNull(reading_id)" in pushed and "Not(In(sensor_type" in pushed

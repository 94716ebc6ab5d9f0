"""Message decode: defaults, dead letters, re-keying."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sensorlake.operators.decode import decode, parsed_bronze, rekey
from sensorlake.operators.silver import build_silver
from sensorlake.session import scratch_path
from sensorlake.streaming import sources


def _frame(spark, payloads):
    return (spark.createDataFrame([(p,) for p in payloads], "v string")
            .select(F.lit("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
                    F.lit("2024-05-06 07:08:09").cast("timestamp").alias("timestamp")))


def test_defaults_and_dead_letter(spark):
    msgs = _frame(spark, [
        '{"reading_id": "r1", "sensor_id": "42", "values": {"P1": 3}}',
        '{"reading_id": "r2", "sensor_id": null, "country": null}',
        '{"sensor_id": "abc"}',
        "not json",
        "[1, 2]",
    ])
    bronze, dead = decode(msgs)
    rows = {r.reading_id: r for r in bronze.collect()}
    assert rows["r1"].sensor_id == 42 and rows["r1"]["values"] == '{"P1":3}'
    assert rows["r2"].sensor_id == 0 and rows["r2"].country == "" and rows["r2"]["values"] == "{}"
    assert rows["r1"].hour == "07" and rows["r1"].month == "05"
    assert sorted(r.reason for r in dead.collect()) == ["invalid_json", "not_a_json_object", "uncastable_sensor_id"]


def test_rekey_empty_key_for_missing_or_zero(spark):
    msgs = _frame(spark, ['{"sensor_id": 0}', '{"x": 1}', '{"sensor_id": 12}', "junk", "[1]", "42", ' {"sensor_id": "0"}'])
    keys = sorted(r.key.decode() for r in rekey(msgs).collect())
    assert keys == ["", "", "0", "12"]


def test_values_given_as_text_stay_json(spark):
    bronze, _ = decode(_frame(spark, ['{"reading_id": "r", "values": "abc"}', '{"reading_id": "s", "values": {"b": 1, "a": "x"}}']))
    assert {r.reading_id: r["values"] for r in bronze.collect()} == {"r": '"abc"', "s": '{"b":1,"a":"x"}'}


ODD = [
    '{"reading_id": "a", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "values": {"P1": 1.5, "P2": "NaN", "pressure": " 7 "}}',
    '{"reading_id": "b", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "values": {"P1": {"z": 1}, "P2": "n/a", "humidity": 1e400}}',
    '{"reading_id": "c", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "values": "abc", "latitude": " 2.5"}',
    '{"reading_id": "d", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "values": null, "sensor_id": true}',
    '{"reading_id": "e", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "values": [1, 2]}',
    '{"reading_id": "f", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "val\\u0075es": {"P\\u0031": 2, "x": "\\ud800"}}',
    '{"reading_id": "g", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "values": {"P1": 0.12345678901234567890123456789, "P2": -0.0, "temperature": 12345678901234567890123456789012345678901}}',
    '{"reading_id": {"h": 1}, "sensor_type": 5, "ingested_at": "2024-03-01T10:00:00+00:00", "country": ["x"]}',
    '{"reading_id": "i", "sensor_type": null, "ingested_at": "2024-03-01T10:00:00+00:00", "values": {"P1": 1}}',
    '{"reading_id": "j", "sensor_type": "t", "ingested_at": "2024-03-01T10:00:00+00:00", "sensor_id": "abc", "values": {"P1": 1}}',
    '{"reading_id": "k", "sensor_type": "t", "values": {"P1": 1, "P1": 2}}', "not json", "[1]", "",
]


def test_silver_is_the_same_from_text_and_from_the_variant(spark):
    msgs = _frame(spark, ODD)
    rows = lambda bronze: sorted(str(r) for r in build_silver(bronze, dedup=False).collect())
    got = rows(parsed_bronze(msgs))
    assert got == rows(decode(msgs)[0].drop("_arrival")) and len(got) == 8
    plan = build_silver(parsed_bronze(msgs), dedup=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan, plan


def test_a_filter_on_the_reason_casts_no_number_again(spark):
    for df in decode(_frame(spark, ODD)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("$.sensor_id, LongType") == 1 and plan.count("$.latitude, DoubleType") == 1, plan


def test_landed_files_can_be_split(spark, monkeypatch):
    monkeypatch.setattr(sources, "ROW_GROUP_BYTES", 1 << 20)
    path = scratch_path(spark, "landed")
    text = F.concat(*[F.sha2(F.concat("id", F.lit(i)).cast("string"), 512) for i in range(4)])
    msgs = spark.range(0, 8000, 1, 1).select(F.lit(b"k").alias("key"), text.cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    sources.land_messages(msgs, path)
    (name,) = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    assert pq.ParquetFile(f"{path.removeprefix('file:')}/{name}").metadata.num_row_groups > 2

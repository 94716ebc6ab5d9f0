"""One decode with two sinks, keyed stream state, tables merged and read by
partition (own values)."""

import os

from pyspark.sql import functions as F

from sensorlake.operators import alerts as al
from sensorlake.operators import registry as rg
from sensorlake.operators.joins import Registry
from sensorlake.operators.partitions import layout_violations, read_bronze
from sensorlake.schemas import ALERT_LOG, DIM_CUSTOMERS
from sensorlake.session import remove_path, scratch_path
from sensorlake.sources.tables import stage_table
from sensorlake.streaming import queries as sq
from sensorlake.streaming.sources import file_messages, land_messages
from tests.test_scale_plans import _dims, _plan


def land(spark, path, texts):
    df = spark.createDataFrame([(t, "2024-03-01 10:00:00") for t in texts], "v string, ts string")
    land_messages(df.select(F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp")), path)


def reading(key, sensor=1):
    return '{"reading_id": "%s", "sensor_id": %d, "values": {"P1": 1}}' % (key, sensor)


def test_a_replayed_batch_leaves_both_sinks_as_they_were(spark):
    msgs, ckpt, out, dead = (scratch_path(spark, n) for n in ("m", "c", "b", "d"))
    start = lambda: sq.run_to_end(sq.ingest(file_messages(spark, msgs), out, dead, ckpt))
    state = lambda: (sorted(str(r) for r in read_bronze(spark, out).collect()), sorted(str(r) for r in spark.read.parquet(dead).collect()))
    land(spark, msgs, [reading("a"), "broken", reading("b")])
    start()
    land(spark, msgs, [reading("c"), "[1]"])
    start()
    before = state()
    assert len(before[0]) == 3 and len(before[1]) == 2
    remove_path(spark, f"{ckpt}/commits/1")
    remove_path(spark, f"{ckpt}/commits/.1.crc")
    start()
    assert os.path.exists(f"{ckpt.removeprefix('file:')}/commits/1")  # it ran again
    assert state() == before
    assert layout_violations(spark, out).count() == 0
    assert not [x for x in os.listdir(os.path.dirname(out)) if x.startswith(os.path.basename(out) + "__batch")]


def test_ingest_over_many_micro_batches(spark):
    """A trigger by time, with a file a batch."""
    msgs, ckpt, out, dead = (scratch_path(spark, n) for n in ("m", "c", "b", "d"))
    for i in range(3):
        land(spark, msgs, [reading(f"r{i}{k}") for k in range(4)])
    files = len([f for f in os.listdir(msgs.removeprefix("file:")) if f.endswith(".parquet")])
    q = sq.ingest(file_messages(spark, msgs, max_files_per_trigger=2), out, dead, ckpt, {"processingTime": "100 milliseconds"})
    try:
        q.processAllAvailable()
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == (files + 1) // 2 > 1
    finally:
        q.stop()
    assert read_bronze(spark, out).select("reading_id").distinct().count() == read_bronze(spark, out).count() == 12


def test_first_seen_is_kept_in_state(spark):
    ds, dc = _dims(spark)
    msgs, ckpt, out = (scratch_path(spark, n) for n in ("m", "c", "a"))
    known = [ds]
    states = []
    for wave in ([reading("a"), reading("b", 5), reading("c", 5)], [reading("d", 5), reading("e", 6)], [reading("f", 5), reading("g", 6), reading("h", 7), reading("i", 8)]):
        if len(states) == 2:  # sensor 8 is registered before the third wave
            known[0] = ds.unionByName(ds.withColumn("sensor_id", F.lit(8).cast("long")))
        land(spark, msgs, wave)
        q = sq.first_seen(file_messages(spark, msgs), lambda s: Registry(known[0], dc), out, ckpt)
        sq.run_to_end(q)
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert states == [1, 2, 3]
    assert sorted((r.sensor_id, r.batch_id) for r in spark.read.parquet(out).collect()) == [(5, 0), (6, 1), (7, 2)]


def test_upsert_leaves_other_buckets_alone(spark):
    rows = [(i, f"c{i}", "Europe") for i in range(40)] + [(None, "none", None)]
    table = rg.BucketedTable(spark, scratch_path(spark, "t"), ["customer_id"], buckets=8)
    table.create(spark.createDataFrame(rows, DIM_CUSTOMERS))
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(table.path.removeprefix("file:")) for f in fs if f.endswith(".parquet")}
    before = files()
    source = spark.createDataFrame([(3, "new", None), (3, "newer", None), (None, "some", "x")], DIM_CUSTOMERS)
    want = sorted(map(str, rg.upsert(table.read(), source, ["customer_id"]).collect()))
    table.upsert(source)
    assert sorted(map(str, table.read().collect())) == want
    assert len(before & files()) >= 6 and before != files()
    table.upsert(source.where("false"))
    assert sorted(map(str, table.read().collect())) == want
    assert "bucket" in _plan(table.read([1])).split("PartitionFilters:")[1].split("]")[0]


def test_feed_reads_from_the_cursors_day_on(spark):
    rows = [(i, i, None, "unregistered_device", "{}", f"2024-03-{1 + i // 10:02d} 0{i % 10}:00:00") for i in range(60)]
    log = spark.createDataFrame(rows, "alert_id long, sensor_id long, reading_id string, alert_type string, payload string, t string")
    log = stage_table(log.withColumn("created_at", F.col("t").cast("timestamp")).select(*ALERT_LOG.names), "log")
    path = scratch_path(spark, "days")
    al.write_log_by_day(log, path)
    for since, key in ((None, None), ("2024-03-03 04:00:00", None), ("2024-03-03 04:00:00", 23), ("2025-01-01 00:00:00", None)):
        got, want = al.feed_from(spark, path, since, key), al.alert_feed(log, since, key)
        assert [r.alert_id for r in got.collect()] == [r.alert_id for r in want.collect()]
    assert al.LOG_DAY in _plan(al.feed_from(spark, path, "2024-03-03 04:00:00")).split("PartitionFilters:")[1].split("]")[0]
    read = al.read_log_by_day(spark, path)
    for n in (3, 25, 60, 100):
        assert [r.alert_id for r in al.latest_from(spark, path, n).collect()] == [r.alert_id for r in al.latest_alerts(log, n).collect()]
    assert al.high_water_by_day(spark, path).first()[0] == read.agg(F.max("created_at")).first()[0]
    assert al.log_days(spark, path) == [f"2024-03-0{d}" for d in range(1, 7)]

"""Plan shapes and storage helpers that the scale design relies on (own values)."""

import time
import types

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import gold
from sensorlake.operators import merge as mg
from sensorlake.operators.joins import Registry, bounded_broadcast, enrich
from sensorlake.operators.silver import build_rejected, build_silver
from sensorlake.session import checkpoint_root, scratch_path
from sensorlake.sources import tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _bronze(spark, rows):
    return spark.createDataFrame(rows, "reading_id string, sensor_id bigint, sensor_type string, "
                                       "ingested_at string, latitude double, longitude double, "
                                       "country string, values string")


def _dims(spark):
    ds = spark.createDataFrame([(1, "SDS011", 0.0, 0.0, "DE", "Europe", 7)],
                               "sensor_id bigint, sensor_type string, latitude double, longitude double, "
                               "country string, region string, customer_id int")
    dc = spark.createDataFrame([(7, "Acme", "Europe")], "customer_id int, customer_name string, region string")
    return ds, dc


def test_validity_filter_stays_above_the_parse(spark):
    """The silver/rejected filters must not be pushed below the timestamp parse
    (which would evaluate the parse twice per row)."""
    b = _bronze(spark, [("a", 1, "SDS011", "2024-03-01T10:00:00+00:00", 0.0, 0.0, "DE", "{}")])
    for df in (build_silver(b, dedup=False), build_rejected(b)):
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in optimized.splitlines() if "Filter" in line]
        assert filters and all("rejection_reason" in line for line in filters), optimized
        assert not any("cast(ingested_at" in line or "RLIKE" in line for line in filters)


def test_bounded_broadcast_falls_back_above_the_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    joined = big.join(bounded_broadcast(small, max_rows=10), "k")
    assert "BroadcastHashJoin" in _plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unhinted = big.join(bounded_broadcast(small, max_rows=9), "k")
        assert "BroadcastHashJoin" not in _plan(unhinted)
        wide = big.join(bounded_broadcast(small.withColumn("pad", F.lit("x" * 100)), max_bytes=999), "k")
        assert "BroadcastHashJoin" not in _plan(wide)          # 10 rows x > 100 bytes
        fits = big.join(bounded_broadcast(small.withColumn("pad", F.lit("x" * 100)), max_bytes=2000), "k")
        assert "BroadcastHashJoin" in _plan(fits)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registry_checks_each_side_once(spark, monkeypatch):
    ds, dc = _dims(spark)
    calls = []
    import sensorlake.operators.joins as joins
    real = joins.bounded_broadcast
    monkeypatch.setattr(joins, "bounded_broadcast", lambda df, n=joins.MAX_BROADCAST_ROWS: calls.append(1) or real(df, n))
    reg = Registry(ds, dc)
    facts = spark.createDataFrame([(1, "FR"), (2, "FR")], "sensor_id bigint, country string")
    rows = {r.sensor_id: (r.country, r.customer_name, r.region)
            for r in enrich(facts, reg).collect() + enrich(facts, reg).collect()}
    assert rows == {1: ("DE", "Acme", "Europe"), 2: ("FR", "Unknown", "Unknown")}
    assert len(calls) == 1


def test_stage_table_round_trip(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    staged = tables.stage_table(df, "t")
    assert staged.schema == df.schema
    assert sorted(tuple(r) for r in staged.collect()) == [(1, "x"), (2, None)]
    assert "FileScan parquet" in _plan(staged)


def test_registry_store_create_write_read(spark):
    ds, dc = _dims(spark)
    root = scratch_path(spark, "registry")
    tables.write_registry(ds, dc, root)
    sensors, customers = tables.read_registry(spark, root)
    assert [tuple(r) for r in sensors.collect()] == [tuple(r) for r in ds.collect()]
    assert [tuple(r) for r in customers.collect()] == [tuple(r) for r in dc.collect()]
    empty = tables.ensure_table(spark, scratch_path(spark, "empty"), ds.schema)
    assert empty.count() == 0 and empty.schema == ds.schema


def _land(spark, root, rows, hour="10"):
    """Bronze rows as one landing in an hour of 2024-03-01."""
    from sensorlake.operators.partitions import write_bronze
    b = _bronze(spark, rows)
    for c, v in (("year", "2024"), ("month", "03"), ("day", "01"), ("hour", hour)):
        b = b.withColumn(c, F.lit(v))
    write_bronze(b, root)


def _row(key, ts, value=1, sensor=1):
    return (key, sensor, "SDS011", ts, 0.0, 0.0, "DE", '{"P1": %s}' % value)


FIRST = [_row("a", "2024-03-01T10:30:00+00:00")]
# what lands with the first run, what with the second (and in which hour)
LANDINGS = {
    "an earlier copy on another day": (FIRST + [_row("b", "2024-03-02T10:00:00+00:00")], [_row("b", "2024-03-01T10:00:00+00:00", 2)], "11"),
    "a copy of equal time": (FIRST + [_row("b", "2024-03-01T09:00:00+00:00", 10)], [_row("b", "2024-03-01T09:00:00+00:00", 9)], "11"),
    "a stamp in 2031": (FIRST + [_row("f", "2031-06-01T00:00:00+00:00")], [_row("b", "2024-03-01T11:00:00+00:00")], "11"),
    "a clock three hours ahead": (FIRST + [_row("c", "2024-03-01T13:30:00+00:00")], [_row("b", "2024-03-01T10:45:00+00:00")], "10"),
    "a row in an hour already read": (FIRST, [_row("b", "2024-03-01T10:01:00+00:00")], "10"),
    "nothing new": (FIRST, [], "10"),
    "the only row of its day moves": ([_row("b", "2024-03-05T10:00:00+00:00")], [_row("b", "2024-03-01T10:00:00+00:00", 2)], "11"),
}


@pytest.mark.parametrize("case", LANDINGS)
def test_incremental_equals_full(spark, case):
    first, second, hour = LANDINGS[case]
    ds, dc = _dims(spark)
    root, silver, full = (scratch_path(spark, n) for n in ("bronze", "silver", "full"))
    marts, full_marts = ({m: scratch_path(spark, m) for m in gold.MARTS} for _ in range(2))
    _land(spark, root, first)
    mg.refresh(spark, root, silver, ds, dc, marts)
    if second:
        _land(spark, root, second, hour)
    mg.refresh(spark, root, silver, ds, dc, marts)
    mg.refresh(spark, root, full, ds, dc, full_marts)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(mg.read_stored_silver(spark, silver)) == rows(mg.read_stored_silver(spark, full))
    for m in gold.MARTS:
        one, two = (rows(spark.read.parquet(p)) if mg.list_files(spark, p).count() else [] for p in (marts[m], full_marts[m]))
        assert one == two, m
    want = len({r[0] for r in first + second})
    assert mg.read_silver(spark, silver).count() == want


def test_full_refresh_over_merged_tables_and_no_scratch_left(spark):
    import os
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    _land(spark, root, FIRST)
    scratch = os.path.dirname(silver)
    there = set(os.listdir(scratch))
    mg.refresh(spark, root, silver)
    _land(spark, root, [_row("b", "2024-03-01T11:00:00+00:00")], "11")
    mg.refresh(spark, root, silver)
    before = sorted(map(str, mg.read_stored_silver(spark, silver).collect()))
    mg.refresh(spark, root, silver, full_refresh=True)
    mg.refresh(spark, root, silver)
    assert sorted(map(str, mg.read_stored_silver(spark, silver).collect())) == before
    names = {os.path.basename(p) for p in (root, silver, mg.file_log(silver))}
    assert set(os.listdir(scratch)) - there <= names


def test_mart_follows_its_model(spark):
    ds, dc = _dims(spark)
    root, silver, path = (scratch_path(spark, n) for n in ("bronze", "silver", "mart"))
    name = "pm25_by_country_hour"
    _land(spark, root, FIRST)
    mg.refresh(spark, root, silver, ds, dc, {name: path})
    model = mg.read_mart(spark, path).columns
    old = tables.stage_table(spark.read.parquet(path).drop("max_pm10").withColumn("legacy", F.lit(1)), "old")
    old.write.mode("overwrite").partitionBy(mg.MART_PARTITION).parquet(path)
    _land(spark, root, [_row("b", "2024-03-02T11:00:00+00:00")], "11")
    mg.refresh(spark, root, silver, ds, dc, {name: path})
    got = mg.read_mart(spark, path)
    assert got.columns == model and got.count() == 2


def test_refresh_sizes_its_shuffles(spark, monkeypatch):
    import sensorlake.session as session
    seen = []
    real = mg.merge_silver
    monkeypatch.setattr(mg, "merge_silver", lambda s, *a: seen.append(s.conf.get("spark.sql.shuffle.partitions")) or real(s, *a))
    monkeypatch.setattr(session, "input_bytes", lambda s, paths: 40 << 30)
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    _land(spark, root, FIRST)
    mg.refresh(spark, root, silver)
    _land(spark, root, [_row("b", "2024-03-02T11:00:00+00:00")], "11")
    mg.refresh(spark, root, silver)
    assert seen == ["40"] and spark.conf.get("spark.sql.shuffle.partitions") == was


def test_size_check_has_no_limit_through_one_task(spark):
    from sensorlake.operators.joins import row_bytes
    df = spark.range(1000).repartition(4)
    plan = _plan(df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))))
    assert "Limit" not in plan and "partial_count" in plan


def test_file_listing_reads_no_content(spark):
    root = scratch_path(spark, "bronze")
    _land(spark, root, FIRST)
    assert "ReadSchema: struct<path:string,length:bigint>" in mg.list_files(spark, root)._jdf.queryExecution().toString()


def test_mart_refresh_prunes_silver_days(spark):
    root, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    _land(spark, root, [_row("a", "2024-03-01T10:00:00+00:00"), _row("b", "2024-03-05T10:00:00+00:00")])
    mg.refresh(spark, root, path)
    silver = mg.read_stored_silver(spark, path)
    touched = tables.stage_table(silver.where("day = '2024-03-05'").select("day", "hour"), "touched")
    plan = _plan(mg.of_days(silver, touched))
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-03-05" in plan and mg.of_days(silver, touched).count() == 1


def test_checkpoint_root_refuses_a_local_folder_on_a_cluster():
    conf = types.SimpleNamespace(get=lambda key, default=None: None)
    sc = types.SimpleNamespace(master="yarn", getConf=lambda: conf)
    fake = types.SimpleNamespace(conf=conf, sparkContext=sc)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)


def test_checkpoint_root_reads_the_session_setting(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_replayed_micro_batch_is_logged_once(spark):
    from sensorlake.streaming.queries import _write_batch
    target = scratch_path(spark, "alerts")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "sensor_id bigint, reading_id string")
    second = spark.createDataFrame([(3, "c")], "sensor_id bigint, reading_id string")
    _write_batch(first, target, 0)
    _write_batch(second.where("false"), target, 7)      # a quiet batch leaves no folder
    _write_batch(second, target, 1)
    _write_batch(first, target, 0)          # replay after a failure between sink commit and offset commit
    rows = sorted((r.batch_id, r.sensor_id) for r in spark.read.parquet(target).collect())
    assert rows == [(0, 1), (0, 2), (1, 3)]


def _run_stream(spark, start, waves):
    from sensorlake.streaming.queries import run_to_end
    from sensorlake.streaming.sources import file_messages, land_messages
    msgs, ckpt = scratch_path(spark, "msgs"), scratch_path(spark, "ckpt")
    for texts in waves:
        df = spark.createDataFrame([(t, "2024-03-01 10:00:00") for t in texts], "v string, ts string")
        land_messages(df.select(F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
                                F.col("ts").cast("timestamp").alias("timestamp")), msgs)
        run_to_end(start(file_messages(spark, msgs), ckpt))


def test_alert_streams_survive_quiet_batches_and_know_new_sensors(spark):
    from sensorlake.streaming import queries as sq
    ds, dc = _dims(spark)
    out, hot = scratch_path(spark, "alerts"), scratch_path(spark, "pressure")
    known = [ds]
    source = lambda s: Registry(known[0], dc)
    msg = lambda sensor, more="": '{"reading_id": "r", %s"latitude": "unknown", "longitude": 2.5%s}' % (f'"sensor_id": {sensor}, ' if sensor is not None else "", more)
    _run_stream(spark, lambda m, c: sq.unregistered_alerts(m, source, out, c), [[msg(1)], [msg(1), msg(None)], [msg(9, ', "extra": [1]')], [msg(9), "[1]"]])
    rows = spark.read.parquet(out).collect()
    assert [(r.sensor_id, r.payload) for r in rows] == [(9, msg(9, ', "extra": [1]'))]
    high = ', "values": {"pressure": "150000"}'
    sent = []

    def start(m, c):
        return sq.pressure_alerts(m, source, hot, c, notify=lambda df: sent.extend(r.message for r in df.collect()))
    _run_stream(spark, start, [[msg(1)], [msg(1, high), msg(None, high), msg(0, ', "values": {"pressure": "NaN"}')]])
    row, = spark.read.parquet(hot).collect()
    assert row.sensor_id == 1 and '"latitude":"unknown","longitude":2.5' in row.payload and '"customer_name":"Acme"' in row.payload
    assert sent == ["[ALERT] Pressure threshold exceeded: sensor_id=1 pressure=150000.0Pa (limit=130000Pa) customer=Acme region=Europe location=(unknown, 2.5)"]


def test_stage_counts_keep_every_batch():
    from types import SimpleNamespace as N

    from sensorlake.streaming.queries import StageCounts
    counts = StageCounts()
    for batch in [*range(250), 249]:
        counts.onQueryProgress(N(progress=N(id="q", batchId=batch, observedMetrics={"bronze": {"rows": 2}})))
    assert counts.totals() == {"bronze": 500}


def test_scale_settings_bound_tasks_and_reducers():
    from sensorlake.session import scale_settings
    tb = 1 << 40
    big = scale_settings(100 * tb, 8000)
    assert big["spark.sql.files.maxPartitionBytes"] == str(512 << 20)
    assert big["spark.sql.shuffle.partitions"] == "100000"          # capped
    mid = scale_settings(5 * tb, 2000)
    assert mid["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert mid["spark.sql.shuffle.partitions"] == str(5 * 1024)      # ~1 GB per reducer
    small = scale_settings(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"             # two waves over the cores


def test_input_bytes_from_metadata(spark):
    from sensorlake.session import input_bytes
    import os
    path = "/root/testdata/sf0.001/events.parquet"
    assert input_bytes(spark, [path]) == os.path.getsize(path)


def _below_exchange(plan: str, operator: str) -> bool:
    """``operator`` occurs in the plan below (after, in tree text) the first Exchange."""
    lines = plan.splitlines()
    first_exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    return any(operator in line for line in lines[first_exchange + 1:])


def test_hot_reading_id_is_cut_before_the_shuffle(spark):
    copies = [("hot", 1, "SDS011", f"2024-03-01T10:{i // 60:02d}:{i % 60:02d}+00:00", 0.0, 0.0, "DE", '{"P1": 1}')
              for i in range(3000)]
    cold = [(f"c{i}", 2, "SDS011", "2024-03-01T11:00:00+00:00", 0.0, 0.0, "DE", '{"P1": 2}') for i in range(50)]
    b = _bronze(spark, list(reversed(copies)) + cold).repartition(8)
    silver = build_silver(b)
    plan = _plan(silver)
    assert "WindowGroupLimit" in plan and _below_exchange(plan, "WindowGroupLimit"), plan
    hot = silver.where("reading_id = 'hot'").collect()
    assert len(hot) == 1 and str(hot[0].ingested_at.time()) == "10:00:00"
    assert silver.count() == 51
    shuffled = next(line for line in plan.splitlines() if "hashpartitioning(reading_id" in line)
    assert shuffled and "values" not in plan.split("WindowGroupLimit")[1].split("Project")[0]


def test_marts_and_alerts_aggregate_map_side(spark):
    from sensorlake.operators import alerts, gold
    ds, dc = _dims(spark)
    b = _bronze(spark, [(f"r{i}", i % 3, "SDS011", "2024-03-01T10:00:00+00:00", 0.0, 0.0, "DE",
                         '{"P1": 1, "temperature": 2}') for i in range(30)])
    silver = build_silver(b)
    for mart in gold.build_marts(silver, Registry(ds, dc)).values():
        plan = _plan(mart)
        assert "partial_count" in plan and "BroadcastHashJoin" in plan, plan
    per_sensor = alerts.unregistered_alerts(silver, Registry(ds, dc))
    assert "partial_min" in _plan(per_sensor)


def test_top_k_not_global_sort(spark):
    from sensorlake.operators import alerts, registry
    assert "TakeOrderedAndProject" in _plan(registry.sample(spark.range(100), k=10))
    log = spark.createDataFrame([(1, 5, None, "pressure_threshold_exceeded", "{}", None)],
                                "alert_id bigint, sensor_id bigint, reading_id string, alert_type string, "
                                "payload string, created_at timestamp")
    assert "TakeOrderedAndProject" in _plan(alerts.latest_alerts(log))


def test_rollover_replay_keeps_one_status_row_per_hour(spark):
    """A replayed batch re-reads the same previous open set and adds nothing."""
    from sensorlake.streaming import queries as sq
    from sensorlake.schemas import MESSAGE
    hours_path, status_path = scratch_path(spark, "hours"), scratch_path(spark, "status")
    captured = {}

    class Writer:     # stands in for writeStream: captures the batch function
        def foreachBatch(self, fn):
            captured["run"] = fn
            return self

    class Frame:
        writeStream = Writer()

    import sensorlake.streaming.queries as mod
    real_decode, real_start = mod.decode, mod._start
    mod.decode = lambda m: (types.SimpleNamespace(select=lambda *c: Frame()), None)
    mod._start = lambda w, c, t: None
    try:
        sq.rollover_status(spark.createDataFrame([], MESSAGE), hours_path, status_path, "unused")
    finally:
        mod.decode, mod._start = real_decode, real_start
    run = captured["run"]

    def batch(*hours):
        return spark.createDataFrame([("2024", "05", "01", h) for h in hours], "year string, month string, day string, hour string")

    run(batch("01", "02"), 0)          # 01 closed, 02 open
    run(batch("02", "03"), 1)          # 02 closed, 03 open
    run(batch("02", "03"), 1)          # replay of batch 1
    run(batch("04"), 2)                # 03 closed via the carried open set
    status = sorted(r.hour for r in spark.read.parquet(status_path).collect())
    assert status == ["01", "02", "03"]


def test_streaming_stage_counts_from_observed_metrics(spark):
    from sensorlake.plans.inputs import Inputs
    from sensorlake.sources import driver_tables as dt
    from sensorlake.streaming import queries as sq
    from sensorlake.streaming.sources import file_messages, land_messages
    inp = Inputs(spark, "/root/testdata/sf0.001")
    msgs, out, dead, ckpt = (scratch_path(spark, n) for n in ("msgs", "bronze", "dead", "ckpt"))
    land_messages(dt.messages_from_events(inp.events), msgs)
    counter = sq.StageCounts()
    spark.streams.addListener(counter)
    try:
        sq.run_to_end(sq.bronze(file_messages(spark, msgs), out, dead, ckpt))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(100):
            counts = counter.totals()
            if len(counts) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert counts["bronze"] == spark.read.parquet(out).count()
    assert counts["dead_letter"] == spark.read.parquet(dead).count()
    assert counts["bronze"] + counts["dead_letter"] == spark.read.parquet(msgs).count()


def test_stage_counts_make_and_decode_messages_once(spark):
    """All layers read the stored decode; before, each made its messages from
    the events and decoded them anew."""
    from sensorlake.plans.catalog import CATALOG
    out = CATALOG["stage_counts"](spark, "/root/testdata/sf0.001")
    assert not [f for f in out.inputFiles() if "events.parquet" in f]
    assert {r["stage"]: r["row_count"] for r in out.collect()} == {r["stage"]: r["row_count"] for r in CATALOG["observed_counts"](spark, "/root/testdata/sf0.001").collect()}


def test_decode_casts_each_number_once(spark):
    from sensorlake.operators.decode import decoded
    msgs = spark.createDataFrame([("k", '{"sensor_id": 1}')], "key string, value string").withColumn("timestamp", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    plan = decoded(msgs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(_v") and plan.count("$.sensor_id, LongType") == 1, plan

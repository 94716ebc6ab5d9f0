"""The query catalog: one named plan per operator family, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; timestamps are
presented as wall-clock UTC (timestamp_ntz) so results do not depend on the
reader's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorlake.constants import ALERT_UNREGISTERED
from sensorlake.functions.scalar import ntz_columns, parse_instant
from sensorlake.operators import gold
from sensorlake.operators.joins import enrich
from sensorlake.operators.silver import _typed, build_rejected, build_silver, classify, earliest_per_reading
from sensorlake.plans.inputs import Inputs
from sensorlake.operators import alerts as al
from sensorlake.operators import merge as mg
from sensorlake.operators import partitions as pt
from sensorlake.operators import quality as qa
from sensorlake.operators import registry as rg
from sensorlake.operators.decode import alert_readings as _alert_readings, decoded as _decoded, rekey as _rekey, split as _split
from sensorlake.operators.deltas import DeltaStore
from sensorlake.schemas import BRONZE, BRONZE_DATA, DIM_CUSTOMERS, PARTITION_COLUMNS, SILVER
from sensorlake.session import remove_path, scratch_path
from sensorlake.sources import driver_tables as _dt
from sensorlake.sources import tables as _tables
from sensorlake.sources.listing import FileLog
from sensorlake.sources.profiles import load_profiles, write_profiles
from sensorlake.sources.snapshot import by_country, land_arrays, read_array, read_snapshot
from sensorlake.streaming import queries as sq
from sensorlake.streaming.sources import file_messages, land_messages

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}
#: What unregistered alerts read of silver.
ALERT_COLUMNS = ["sensor_id", "country", "latitude", "longitude", "sensor_type", "ingested_at"]


def register(name: str):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return ntz_columns(fn(Inputs(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        CATALOG[name] = run
        return run
    return wrap


def _mart(name: str, inp: Inputs) -> DataFrame:
    return gold.MARTS[name](enrich(inp.silver, inp.registry))


@register("gold_pm25")
def gold_pm25(inp: Inputs) -> DataFrame:
    """Hourly PM mart (A1): silver LEFT registry, grouped by hour/country/region/customer."""
    return _mart("pm25_by_country_hour", inp)


@register("gold_temperature")
def gold_temperature(inp: Inputs) -> DataFrame:
    return _mart("temperature_by_region_day", inp)


@register("gold_activity")
def gold_activity(inp: Inputs) -> DataFrame:
    return _mart("sensor_activity_by_customer", inp)


@register("gold_pm25_sorted")
def gold_pm25_sorted(inp: Inputs) -> DataFrame:
    return gold.sorted_mart("pm25_by_country_hour", _mart("pm25_by_country_hour", inp))


@register("gold_temperature_sorted")
def gold_temperature_sorted(inp: Inputs) -> DataFrame:
    return gold.sorted_mart("temperature_by_region_day", _mart("temperature_by_region_day", inp))


@register("gold_activity_sorted")
def gold_activity_sorted(inp: Inputs) -> DataFrame:
    return gold.sorted_mart("sensor_activity_by_customer", _mart("sensor_activity_by_customer", inp))


@register("silver_readings")
def silver_readings(inp: Inputs) -> DataFrame:
    return inp.silver


@register("silver_unfiltered")
def silver_unfiltered(inp: Inputs) -> DataFrame:
    """Older full-refresh silver: typed and deduplicated, nothing filtered."""
    return build_silver(inp.bronze, validate=False)


@register("rejected_readings")
def rejected_readings(inp: Inputs) -> DataFrame:
    return build_rejected(inp.bronze).drop("detected_at")


@register("enriched_readings")
def enriched_readings(inp: Inputs) -> DataFrame:
    e = enrich(inp.silver, inp.registry)
    return e.select("reading_id", "sensor_id", "sensor_type", "ingested_at", "latitude",
                    "longitude", "country", "pm25", "pm10", "temperature", "humidity",
                    "pressure", "pressure_at_sealevel", "customer_id", "customer_name", "region")


# ---------------------------------------------------------------- decode, alerts


FIRST_RUN_CUT = "2024-01-01 06:00:00"   # end of the first (earlier) pipeline run
FEED_SINCE = "2024-01-20 00:00:00"      # high-water mark of a feed reader


@register("bronze_decode")
def bronze_decode(inp: Inputs) -> DataFrame:
    """Messages -> bronze rows (defaults applied; bad payloads to dead-letter)."""
    return inp.decoded_bronze.drop("_arrival")


@register("dead_letter")
def dead_letter(inp: Inputs) -> DataFrame:
    return inp.dead_letter.drop("key")


@register("rekey")
def rekey(inp: Inputs) -> DataFrame:
    r = _rekey(inp.messages)
    return r.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _pressure(inp: Inputs, readings: DataFrame | None = None) -> DataFrame:
    return al.pressure_alerts(inp.alert_readings if readings is None else readings, inp.registry, None)


@register("pressure_alerts")
def pressure_alerts(inp: Inputs) -> DataFrame:
    """Every breach of the pressure limit, with customer context and payload."""
    return _pressure(inp).select(
        "sensor_id", "reading_id", "alert_type", "payload", "created_at",
        F.get_json_object("payload", "$.pressure").cast("double").alias("pressure"),
        F.get_json_object("payload", "$.customer_name").alias("customer_name"),
        F.get_json_object("payload", "$.region").alias("region"))


@register("alert_messages")
def alert_messages(inp: Inputs) -> DataFrame:
    return _pressure(inp).select("sensor_id", "reading_id", "created_at", "message")


@register("unregistered_sensors")
def unregistered_sensors(inp: Inputs) -> DataFrame:
    return al.unregistered_sensors(inp.silver, inp.registry)


def _alerted_twice(inp: Inputs, silver: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Unregistered alerts of a first run and the new ones of a second. Without
    a stored ``silver``, its columns that alerts read are stored once for both
    runs; the first run's log is stored, as the second reads it."""
    if silver is None:
        silver = _tables.stage_table(inp.silver.select(*ALERT_COLUMNS), "alert_silver")
    first = _tables.stage_table(al.unregistered_alerts(silver.where(F.col("ingested_at") < F.lit(FIRST_RUN_CUT)), inp.registry), "first_alerts")
    return first, al.unregistered_alerts(silver, inp.registry, alert_log=first)


def _alert_log(inp: Inputs, silver: DataFrame | None = None, readings: DataFrame | None = None) -> DataFrame:
    """Alert log as two runs leave it: unregistered alerts of the first run,
    new ones of the second, and every pressure breach."""
    first, second = _alerted_twice(inp, silver)
    return first.unionByName(second).unionByName(_pressure(inp, readings).drop("message"))


@register("new_unregistered_alerts")
def new_unregistered_alerts(inp: Inputs) -> DataFrame:
    """Second run's unregistered alerts: sensors not alerted by the first run."""
    return _alerted_twice(inp)[1].select("sensor_id", "alert_type", "payload", "created_at")


@register("alert_feed")
def alert_feed(inp: Inputs) -> DataFrame:
    feed = al.alert_feed(_alert_log(inp), since_created_at=FEED_SINCE)
    return feed.select("sensor_id", "reading_id", "alert_type", "created_at", "detail")


@register("alert_feed_resumed")
def alert_feed_resumed(inp: Inputs) -> DataFrame:
    """The feed of a reader that starts at the high-water mark of what it saw."""
    log = _tables.stage_table(_alert_log(inp), "alert_log")
    seen = al.feed_high_water(log.where(F.col("created_at") <= F.lit(FEED_SINCE).cast("timestamp")))
    feed = al.alert_feed(log, since_created_at=seen.first()["created_at"])
    return feed.select("sensor_id", "reading_id", "alert_type", "created_at", "detail")


def _log_by_day(inp: Inputs) -> str:
    path = scratch_path(inp.spark, "alert_days")
    al.write_log_by_day(_tables.stage_table(_alert_log(inp), "alert_log"), path)
    return path


@register("alert_feed_pruned")
def alert_feed_pruned(inp: Inputs) -> DataFrame:
    """The resumed feed over a log stored by day: folders before the cursor's
    day are not read."""
    path = _log_by_day(inp)
    seen = al.feed_high_water(al.read_log_by_day(inp.spark, path).where((F.col(al.LOG_DAY) <= FEED_SINCE[:10]) & (F.col("created_at") <= F.lit(FEED_SINCE).cast("timestamp"))))
    feed = al.feed_from(inp.spark, path, since_created_at=seen.first()["created_at"])
    return feed.select("sensor_id", "reading_id", "alert_type", "created_at", "detail")


@register("alert_latest_pruned")
def alert_latest_pruned(inp: Inputs) -> DataFrame:
    """The newest alerts from the newest days of the log."""
    return al.latest_from(inp.spark, _log_by_day(inp)).select("sensor_id", "reading_id", "alert_type", "created_at", "detail")


@register("alert_feed_latest")
def alert_feed_latest(inp: Inputs) -> DataFrame:
    return al.latest_alerts(_alert_log(inp)).select("sensor_id", "reading_id", "alert_type",
                                                    "created_at", "detail")


@register("stage_counts")
def stage_counts(inp: Inputs) -> DataFrame:
    """Rows per pipeline stage: one aggregate per layer, unpivoted. Messages
    are made and decoded once and stored for all layers; a stored message is
    its text, once."""
    stored = _tables.stage_table(_decoded(inp.messages).drop("value", "event_id"), "decoded")
    bronze, dead_letter = _split(stored)
    messages = stored.select("key", F.col("_text").alias("value"), "timestamp")
    msgs = messages.agg(F.count(F.lit(1)).alias("messages_in"))
    dec = classify(bronze).agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.col("rejection_reason").isNotNull()).alias("rejected"))
    dead = dead_letter.agg(F.count(F.lit(1)).alias("dead_letter"))
    silver = build_silver(bronze.drop("_arrival")).agg(F.count(F.lit(1)).alias("silver_rows"))
    alerts = _alert_log(inp, readings=_alert_readings(messages)).agg(
        F.count_if(F.col("alert_type") == ALERT_UNREGISTERED).alias("unregistered_alerts"),
        F.count_if(F.col("alert_type") != ALERT_UNREGISTERED).alias("pressure_alerts"))
    parts = [msgs, dec, dead, silver, alerts]
    out = None
    for part in parts:
        names = part.columns
        stack = "stack({}, {}) as (stage, row_count)".format(
            len(names), ", ".join(f"'{n}', {n}" for n in names))
        rows = part.selectExpr(stack)
        out = rows if out is None else out.unionByName(rows)
    return out


@register("observed_counts")
def observed_counts(inp: Inputs) -> DataFrame:
    """``stage_counts`` from observations that ride on the refresh's own writes:
    messages are decoded once and staged, silver and the alert log are written
    from that, and each write counts its rows as it goes."""
    one, spark = F.lit(1), inp.spark
    seen = [Observation() for _ in range(4)]
    frame = _decoded(inp.messages).observe(seen[0], F.count(one).alias("messages_in"), F.count_if(F.col("_reason").isNull()).alias("bronze_rows"),
                                           F.count_if(F.col("_reason").isNotNull()).alias("dead_letter"))
    bronze, _ = _split(_tables.stage_table(frame, "decoded"))
    typed = _typed(classify(bronze.drop("_arrival")).observe(seen[1], F.count_if(F.col("rejection_reason").isNotNull()).alias("rejected"))
                   .where(F.col("rejection_reason").isNull()))
    _tables.stage_table(earliest_per_reading(typed).observe(seen[2], F.count(one).alias("silver_rows")), "silver")
    unregistered = F.col("alert_type") == ALERT_UNREGISTERED
    log = _alert_log(inp).observe(seen[3], F.count_if(unregistered).alias("unregistered_alerts"), F.count_if(~unregistered).alias("pressure_alerts"))
    _tables.stage_table(log, "alert_log")
    return spark.createDataFrame([(k, int(v)) for o in seen for k, v in o.get.items()], "stage string, row_count long")


# ---------------------------------------------------------------- registry


def _flat_snapshot(snap: DataFrame) -> DataFrame:
    return snap.select(
        "id", "timestamp", F.col("sensor.id").alias("sensor_id"),
        F.coalesce(F.col("sensor.sensor_type.name"), F.lit("unknown")).alias("sensor_type"),
        F.col("location.latitude").alias("latitude"), F.col("location.longitude").alias("longitude"),
        F.coalesce(F.col("location.country"), F.lit("")).alias("country"),
        F.size(F.coalesce(F.col("sensordatavalues"), F.array())).alias("n_values"))


@register("snapshot_flat")
def snapshot_flat(inp: Inputs) -> DataFrame:
    """Landed snapshot scanned with its nested schema and flattened."""
    return _flat_snapshot(inp.snapshot)


@register("snapshot_array")
def snapshot_array(inp: Inputs) -> DataFrame:
    """The snapshot as the source sends it: JSON arrays, one to a file."""
    path = land_arrays(inp.snapshot, scratch_path(inp.spark, "snapshot_array"))
    return _flat_snapshot(read_snapshot(inp.spark, path, multiline=True))


@register("snapshot_split")
def snapshot_split(inp: Inputs) -> DataFrame:
    """The same arrays, each split over tasks."""
    return _flat_snapshot(read_array(inp.spark, land_arrays(inp.snapshot, scratch_path(inp.spark, "snapshot_split"))))


@register("snapshot_country")
def snapshot_country(inp: Inputs) -> DataFrame:
    return _flat_snapshot(by_country(inp.snapshot, "DE"))


@register("latest_per_sensor")
def latest_per_sensor(inp: Inputs) -> DataFrame:
    return _flat_snapshot(rg.latest_per_sensor(inp.snapshot))


@register("sensor_profiles")
def sensor_profiles(inp: Inputs) -> DataFrame:
    return rg.flat_ranges(rg.profiles(inp.snapshot))


@register("region_assignment")
def region_assignment(inp: Inputs) -> DataFrame:
    p = rg.profiles(inp.snapshot)
    return p.select("id", "country", "latitude", "longitude", rg.assign_region().alias("region"))


@register("customer_assignment")
def customer_assignment(inp: Inputs) -> DataFrame:
    return rg.dim_sensors_from_profiles(rg.profiles(inp.snapshot))


@register("profile_sample_count")
def profile_sample_count(inp: Inputs) -> DataFrame:
    """Sizes of two uniform profile samples (1000, and 20 of more), and how many
    of the smaller are profiles, each once."""
    profiles = rg.profiles(inp.snapshot)
    few = rg.sample(profiles, 20)
    known = few.select("id").distinct().join(profiles.select("id"), "id", "left_semi")
    return (rg.sample(profiles).agg(F.count(F.lit(1)).alias("sampled"))
            .crossJoin(F.broadcast(few.agg(F.count(F.lit(1)).alias("sampled_20"))))
            .crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("known_20")))))


@register("upsert_dims")
def upsert_dims(inp: Inputs) -> DataFrame:
    """Supplier registry merged with the full-coverage customer registry."""
    newer = _dt.dims_from_customer_table(inp.table("customer"), inp.table("nation"), inp.table("region"))
    return rg.upsert(inp.dim_sensors, newer.where("sensor_id % 3 <> 0"), ["sensor_id"])


@register("upsert_buckets")
def upsert_buckets(inp: Inputs) -> DataFrame:
    """``upsert_dims`` in place: only buckets of merged keys are rewritten."""
    newer = _dt.dims_from_customer_table(inp.table("customer"), inp.table("nation"), inp.table("region"))
    table = rg.BucketedTable(inp.spark, scratch_path(inp.spark, "dim_buckets"), ["sensor_id"], buckets=16)
    table.create(inp.dim_sensors)
    table.upsert(newer.where("sensor_id % 3 <> 0"))
    return table.read()


@register("upsert_customers")
def upsert_customers(inp: Inputs) -> DataFrame:
    """A registry created with the seeded customers, then merged with the even
    nations: matched rows change, others stay, new ones come in."""
    path = scratch_path(inp.spark, "customers")
    stored = _tables.ensure_table(inp.spark, path, DIM_CUSTOMERS, seed=rg.seed_customers(inp.spark))
    return rg.upsert(stored, inp.dim_customers.where("customer_id % 2 = 0"), ["customer_id"])


@register("insert_if_absent")
def insert_if_absent(inp: Inputs) -> DataFrame:
    newer = _dt.dims_from_customer_table(inp.table("customer"), inp.table("nation"), inp.table("region"))
    return rg.insert_if_absent(inp.dim_sensors, newer, ["sensor_id"])


@register("stored_profiles")
def stored_profiles(inp: Inputs) -> DataFrame:
    """Profiles written to Parquet and read back (map column intact)."""
    path = write_profiles(rg.profiles(inp.snapshot), scratch_path(inp.spark, "profiles"))
    return rg.flat_ranges(load_profiles(inp.spark, path))


@register("registry_store")
def registry_store(inp: Inputs) -> DataFrame:
    """Registry round trip through the registry store (S8, S19): tables created
    if missing, replaced in bulk, scanned back with explicit column lists.

    The store is a pair of Parquet tables on shared storage; over a JDBC URL
    the same calls are ``sources/jdbc.py``. No database is started here, so
    the JDBC form is not exercised by this query.
    """
    root = scratch_path(inp.spark, "registry")
    _tables.write_registry(inp.dim_sensors, inp.dim_customers, root)
    sensors, customers = _tables.read_registry(inp.spark, root)
    return sensors.join(customers.withColumnRenamed("region", "customer_region"), "customer_id", "left") \
        .select("sensor_id", "sensor_type", "latitude", "longitude", "country", "region",
                "customer_id", "customer_name")


# ------------------------------------------------- layout, partitions, merges, quality


NOW = "2024-01-20 12:30:00"            # fixed "now" of the partition scenario
CONSUMER_STOPPED = "2024-01-19 06:00:00"  # last rollover the live consumer saw
INCREMENT_CUT = "2024011600"            # bronze hours before this went to the first run


@register("bronze_roundtrip")
def bronze_roundtrip(inp: Inputs) -> DataFrame:
    """Bronze written partitioned by hour and read back with string partitions."""
    return inp.landed_bronze


@register("partition_columns")
def partition_columns(inp: Inputs) -> DataFrame:
    return inp.landed_bronze.select(*PARTITION_COLUMNS).distinct()


def _status(inp: Inputs) -> DataFrame:
    return pt.rollover_status(inp.landed_hours, CONSUMER_STOPPED)


@register("missing_markers")
def missing_markers(inp: Inputs) -> DataFrame:
    return pt.missing_markers(inp.landed_hours, _status(inp), NOW)


@register("partition_status")
def partition_status(inp: Inputs) -> DataFrame:
    return pt.backfill(inp.landed_hours, _status(inp), NOW)


@register("ready_hours")
def ready_hours(inp: Inputs) -> DataFrame:
    return pt.ready_hours(inp.landed_hours, pt.backfill(inp.landed_hours, _status(inp), NOW))


@register("file_manifest")
def file_manifest(inp: Inputs) -> DataFrame:
    """Hours of the manifest's files (names are random) and whether each short
    key names its hour and each file has a size."""
    m = pt.file_manifest(inp.spark, inp.landed_path, "2024-01-20 00:30:00")
    hour = F.concat(F.lit("hour="), F.col("hour"))
    return m.groupBy(*PARTITION_COLUMNS).agg(
        F.bool_and(F.col("short_key").rlike(r"^month=\d{2}/day=\d{2}/hour=\d{2}/[^/]+\.parquet$") & F.col("short_key").contains(hour)).alias("keys_ok"),
        F.bool_and(F.col("size_kb") > 0).alias("sizes_ok"))


def _two_runs(inp: Inputs, marts: list[str], full_again: bool = False) -> tuple[str, dict[str, str]]:
    """First run: a full build over what has landed. Then the rest lands, some
    of it in hours already read, and a second run takes the new files (or, with
    ``full_again``, builds everything anew over the stored tables)."""
    spark, root = inp.spark, scratch_path(inp.spark, "bronze")
    silver_path = scratch_path(spark, "silver")
    mart_paths = {m: scratch_path(spark, m) for m in marts}
    for again, landing in enumerate(_dt.two_landings(inp.events, INCREMENT_CUT)):
        pt.write_bronze(landing, root)
        mg.refresh(spark, root, silver_path, inp.registry, None, mart_paths, full_refresh=bool(again) and full_again)
    return silver_path, mart_paths


@register("incremental_silver")
def incremental_silver(inp: Inputs) -> DataFrame:
    path, _ = _two_runs(inp, [])
    return mg.read_silver(inp.spark, path).select(*[f.name for f in SILVER.fields])


@register("full_refresh_silver")
def full_refresh_silver(inp: Inputs) -> DataFrame:
    """The full-refresh switch over a table that already holds a first run."""
    path, _ = _two_runs(inp, [], full_again=True)
    return mg.read_silver(inp.spark, path).select(*[f.name for f in SILVER.fields])


def _incremental_mart(inp: Inputs, name: str) -> DataFrame:
    _, paths = _two_runs(inp, [name])
    return mg.read_mart(inp.spark, paths[name])


@register("incremental_gold_pm25")
def incremental_gold_pm25(inp: Inputs) -> DataFrame:
    return _incremental_mart(inp, "pm25_by_country_hour")


@register("incremental_gold_temperature")
def incremental_gold_temperature(inp: Inputs) -> DataFrame:
    return _incremental_mart(inp, "temperature_by_region_day")


@register("incremental_gold_activity")
def incremental_gold_activity(inp: Inputs) -> DataFrame:
    return _incremental_mart(inp, "sensor_activity_by_customer")


def _delta_store(inp: Inputs, marts: list[str]) -> DeltaStore:
    """The two landings of ``_two_runs`` through a store that is kept by deltas,
    the files of each found by the folders that changed."""
    spark, root = inp.spark, scratch_path(inp.spark, "bronze")
    store = DeltaStore(spark, scratch_path(spark, "deltas"), inp.registry, marts, buckets=8)
    for landing in _dt.two_landings(inp.events, INCREMENT_CUT):
        pt.write_bronze(landing, root)
        store.refresh(root)
    return store


@register("indexed_silver")
def indexed_silver(inp: Inputs) -> DataFrame:
    """Silver merged by way of the id index: stored copies are looked up in the
    increment's buckets, hours gain batches and are not rewritten."""
    return _delta_store(inp, []).silver()


@register("delta_gold_pm25")
def delta_gold_pm25(inp: Inputs) -> DataFrame:
    """The hourly mart kept by retractable aggregates of what merges changed."""
    return _delta_store(inp, ["pm25_by_country_hour"]).mart("pm25_by_country_hour")


@register("delta_gold")
def delta_gold(inp: Inputs) -> DataFrame:
    """The daily climate mart kept by retractable aggregates."""
    return _delta_store(inp, ["temperature_by_region_day"]).mart("temperature_by_region_day")


@register("delta_gold_activity")
def delta_gold_activity(inp: Inputs) -> DataFrame:
    """Exact distinct counts kept by counted members; read after compaction."""
    store = _delta_store(inp, ["sensor_activity_by_customer"])
    store.compact()
    return store.mart("sensor_activity_by_customer")


@register("listed_increment")
def listed_increment(inp: Inputs) -> DataFrame:
    """Rows of each landing, from the files that its changed folders hold: the
    second one adds files to hours that the first has read."""
    spark, root = inp.spark, scratch_path(inp.spark, "bronze")
    log, out = FileLog(spark, scratch_path(spark, "file_log")), None
    for number, landing in enumerate(_dt.two_landings(inp.events, INCREMENT_CUT)):
        pt.write_bronze(landing, root)
        found = log.new_files(root)
        paths = [r["path"] for r in found.files.select("path").collect()]
        rows = _tables.read_files(spark, paths, BRONZE, root).groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
        rows = _tables.stage_table(rows.withColumn("landing", F.lit(number)), "listed")
        out = rows if out is None else out.unionByName(rows)
        log.commit(found)
    return out


@register("schema_sync")
def schema_sync(inp: Inputs) -> DataFrame:
    """A silver table stored under an older schema, brought to the model's columns."""
    path = scratch_path(inp.spark, "old_silver")
    old = inp.silver.drop("pressure_at_sealevel").withColumn("legacy_flag", F.lit(True))
    old.write.mode("overwrite").parquet(path)
    return mg.sync_columns(inp.spark.read.parquet(path), SILVER)


@register("full_refresh_counts")
def full_refresh_counts(inp: Inputs) -> DataFrame:
    """Create-or-replace every table in build order (silver first, the marts
    from the written silver), then count rows of what was written."""
    silver = _tables.stage_table(inp.silver, "silver")
    tables = {"silver": silver, "rejected": _tables.stage_table(build_rejected(inp.bronze), "rejected")}
    tables.update({name: _tables.stage_table(df, name)
                   for name, df in gold.build_marts(silver, inp.registry).items()})
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


@register("quality_report")
def quality_report(inp: Inputs) -> DataFrame:
    """Post-build checks over the written tables: silver is stored once and
    the marts are built from it, so no table is recomputed per check."""
    silver = _tables.stage_table(inp.silver, "silver")
    marts = gold.build_marts(silver, inp.registry)
    return qa.quality_report(inp.bronze, silver, build_rejected(inp.bronze), marts)


@register("observed_quality")
def observed_quality(inp: Inputs) -> DataFrame:
    """``quality_report`` counted by the writes that build the tables."""
    return qa.observed_quality(inp.bronze, build_silver, build_rejected, lambda s: gold.build_marts(s, inp.registry), _tables.stage_table)


@register("quality_schema")
def quality_schema(inp: Inputs) -> DataFrame:
    """Schema, required columns, NULLs, layout and future timestamps of landed bronze."""
    b = inp.landed_bronze
    rows = qa.schema_checks(b, BRONZE, required=["reading_id", "sensor_id", "ingested_at", "values"])
    meta = inp.spark.createDataFrame(rows, "check string, column_name string, expected string, actual string, ok boolean")
    meta = meta.withColumn("failing_rows", F.when(F.col("ok"), 0).otherwise(1).cast("bigint"))
    layout = pt.layout_violations(inp.spark, inp.landed_path).agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit("hive_layout").alias("check"), F.lit("_metadata.file_path").alias("column_name"),
        F.lit(None).cast("string").alias("expected"), F.lit(None).cast("string").alias("actual"),
        (F.col("failing_rows") == 0).alias("ok"), "failing_rows")
    future = qa.future_timestamps(b, parse_instant("ingested_at"), NOW).select(
        F.lit("future_timestamp").alias("check"), F.lit("ingested_at").alias("column_name"),
        F.lit(None).cast("string").alias("expected"), F.lit(None).cast("string").alias("actual"),
        (F.col("failing_rows") == 0).alias("ok"), "failing_rows")
    nulls = qa.null_counts(b, [f.name for f in BRONZE_DATA.fields]).select(
        F.lit("not_null").alias("check"), "column_name", F.lit(None).cast("string").alias("expected"),
        F.lit(None).cast("string").alias("actual"), (F.col("failing_rows") == 0).alias("ok"), "failing_rows")
    return meta.unionByName(layout).unionByName(future).unionByName(nulls)


@register("scalar_suite")
def scalar_suite(inp: Inputs) -> DataFrame:
    """Per-row scalar functions: parse, interval arithmetic, division, JSON text, casts."""
    b = inp.bronze
    ts = parse_instant("ingested_at")
    return b.select(
        "reading_id", "sensor_id",
        ts.alias("parsed_at"),
        (ts - F.expr("INTERVAL 1 HOUR")).alias("hour_before"),
        (ts - F.make_dt_interval(hours=F.lit(48))).alias("lookback_start"),
        (F.col("sensor_id") / 7).alias("ratio"),
        F.to_json(F.struct("reading_id", "sensor_id"), {"ignoreNullFields": "false"}).alias("as_json"),
        F.col("reading_id").try_cast("bigint").alias("id_number"),
        F.date_format(ts, "HH").alias("hour_text"))


# ---------------------------------------------------------------- streaming


def _two_waves(inp: Inputs, start, waves: list[DataFrame] | None = None) -> None:
    """Land one wave, run the query to its end; land the other, restart the
    same query from its checkpoint and run it to the end again."""
    spark = inp.spark
    msg_dir = scratch_path(spark, "messages")
    ckpt = scratch_path(spark, "checkpoint")
    inp.streamed = msg_dir
    for wave in waves or [_dt.messages_from_events(inp.events, copy=c) for c in (0, 1)]:
        land_messages(wave, msg_dir)
        sq.run_to_end(start(file_messages(spark, msg_dir), ckpt))


def _registry_source(inp: Inputs):
    """Reads the registry tables anew whenever a batch asks."""
    return lambda spark: Inputs(spark, inp.sf_dir).registry


@register("stream_bronze")
def stream_bronze(inp: Inputs) -> DataFrame:
    out, dead = scratch_path(inp.spark, "s_bronze"), scratch_path(inp.spark, "s_dead")
    _two_waves(inp, lambda m, c: sq.bronze(m, out, dead, c))
    return pt.read_bronze(inp.spark, out)


def _late_waves(inp: Inputs) -> list[DataFrame]:
    """Messages with late deliveries, earlier copies and a clock in 2031; the
    second wave brings deliveries 15 days old, copies 36 hours earlier and all
    redeliveries."""
    return list(_dt.late_messages(inp.events))


@register("stream_silver_dedup")
def stream_silver_dedup(inp: Inputs) -> DataFrame:
    out = scratch_path(inp.spark, "s_silver")
    _two_waves(inp, lambda m, c: sq.silver_dedup(m, out, c), _late_waves(inp))
    return mg.read_silver(inp.spark, out)


@register("stream_ingest")
def stream_ingest(inp: Inputs) -> DataFrame:
    """Bronze and dead letters of one query over two waves with a restart; the
    last batch is then delivered again, as after a lost commit."""
    spark = inp.spark
    out, dead = scratch_path(spark, "s_bronze"), scratch_path(spark, "s_dead")
    seen = []

    def start(m, c):
        seen.append(c)
        return sq.ingest(m, out, dead, c)
    _two_waves(inp, start)
    msg_dir, ckpt = inp.streamed, seen[-1]
    remove_path(spark, f"{ckpt}/commits/1")
    remove_path(spark, f"{ckpt}/commits/.1.crc")
    sq.run_to_end(sq.ingest(file_messages(spark, msg_dir), out, dead, ckpt))
    bronze = pt.read_bronze(spark, out).select(*[f.name for f in BRONZE.fields], F.lit(None).cast("string").alias("reason"))
    letters = spark.read.parquet(dead).select(F.col("raw_value").alias("values"), "reason")
    return bronze.unionByName(letters, allowMissingColumns=True)


@register("stream_first_seen")
def stream_first_seen(inp: Inputs) -> DataFrame:
    """Unregistered sensors and the wave that they are first seen in, over three
    waves with a restart before each but the first."""
    out = scratch_path(inp.spark, "s_first")
    waves = [inp.messages.where(F.col("event_id") % 3 == i) for i in range(3)]
    _two_waves(inp, lambda m, c: sq.first_seen(m, _registry_source(inp), out, c), waves)
    return inp.spark.read.parquet(out).select("sensor_id", "alert_type", F.col("batch_id").cast("int").alias("wave"))


@register("stream_alerts")
def stream_alerts(inp: Inputs) -> DataFrame:
    out = scratch_path(inp.spark, "s_alerts")
    _two_waves(inp, lambda m, c: sq.pressure_alerts(m, _registry_source(inp), out, c))
    return inp.spark.read.parquet(out).select("sensor_id", "reading_id", "alert_type", "payload", "created_at")


@register("stream_unregistered")
def stream_unregistered(inp: Inputs) -> DataFrame:
    """The first wave holds registered sensors only, so its batches raise nothing."""
    out = scratch_path(inp.spark, "s_unreg")
    known = inp.dim_sensors.select(F.col("sensor_id").cast("string").cast("binary").alias("key"))
    quiet = inp.messages.join(known, "key", "left_semi").select(*inp.messages.columns)
    loud = inp.messages.join(known, "key", "left_anti").select(*inp.messages.columns)
    _two_waves(inp, lambda m, c: sq.unregistered_alerts(m, _registry_source(inp), out, c), [quiet, loud])
    return inp.spark.read.parquet(out).select("sensor_id", "alert_type", "payload", "created_at")


@register("stream_hourly")
def stream_hourly(inp: Inputs) -> DataFrame:
    silver, out = scratch_path(inp.spark, "s_silver"), scratch_path(inp.spark, "s_hourly")
    _two_waves(inp, lambda m, c: sq.hourly(m, silver, out, c), _late_waves(inp))
    return inp.spark.read.parquet(out).drop("part_day")


@register("stream_hourly_delta")
def stream_hourly_delta(inp: Inputs) -> DataFrame:
    """The same counts from partial aggregates of each batch's changes."""
    root = scratch_path(inp.spark, "s_deltas")
    _two_waves(inp, lambda m, c: sq.hourly_delta(m, DeltaStore(inp.spark, root, marts=["hourly"], buckets=8), c), _late_waves(inp))
    return DeltaStore(inp.spark, root, marts=["hourly"]).mart("hourly")


@register("stream_from_kafka_frame")
def stream_from_kafka_frame(inp: Inputs) -> DataFrame:
    """Kafka-shaped frame (fed from files here) re-keyed and republished to a sink."""
    out = scratch_path(inp.spark, "s_rekey")

    def start(m, c):
        r = _rekey(m).select(F.col("key").cast("string").alias("key"),
                                   F.col("value").cast("string").alias("value"))
        return r.writeStream.format("parquet").option("path", out).option("checkpointLocation", c) \
            .trigger(availableNow=True).start()
    _two_waves(inp, start)
    return inp.spark.read.parquet(out)


@register("new_items")
def new_items(inp: Inputs) -> DataFrame:
    """Set difference: sensors first seen after the first run (anti join on id)."""
    s = inp.silver
    before = s.where(F.col("ingested_at") < F.lit(FIRST_RUN_CUT)).select("sensor_id")
    return s.where(F.col("ingested_at") >= F.lit(FIRST_RUN_CUT)).select("sensor_id").distinct() \
        .join(before.distinct(), "sensor_id", "left_anti")


@register("stream_partition_status")
def stream_partition_status(inp: Inputs) -> DataFrame:
    """Hour partitions closed by the streaming ingest as it passes them. Before
    its second start the bronze it has landed is back-filled; the hours are
    closed already, so that adds nothing twice."""
    hours, status = scratch_path(inp.spark, "s_hours"), scratch_path(inp.spark, "s_status")
    _two_waves(inp, lambda m, c: sq.rollover_status(m, hours, status, c, bronze_path=inp.landed_path, now="2024-01-01 00:00:00"))
    return inp.spark.read.parquet(status)

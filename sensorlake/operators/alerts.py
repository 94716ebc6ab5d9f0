"""Alerts: pressure threshold per reading, unregistered devices once per sensor.

The alert log is an append-only DataFrame with schema ``schemas.ALERT_LOG``.
``alert_id`` is a deterministic hash of (type, sensor, reading) so a replayed
micro-batch produces the same ids and can be skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.constants import (ALERT_PRESSURE, ALERT_UNREGISTERED, FEED_WINDOW_ROWS,
                                  PRESSURE_THRESHOLD_PA)
from sensorlake.functions.scalar import json_double, parse_values
from sensorlake.operators.joins import as_registry, customer_lookup
from sensorlake.schemas import ALERT_LOG

# FIXED VALUES: text of the pressure notification.
PRESSURE_MESSAGE = ("[ALERT] Pressure threshold exceeded: sensor_id=%s pressure=%.1fPa (limit=%.0fPa) "
                    "customer=%s region=%s location=(%s, %s)")
UNKNOWN = "Unknown"


def alert_id(alert_type: Column, sensor_id: Column, reading_id: Column) -> Column:
    return F.xxhash64(alert_type, sensor_id, F.coalesce(reading_id, F.lit("")))


def pressure_of(values_text) -> Column:
    return json_double(parse_values(values_text), "$.pressure")


def breach(pressure: Column, limit: float = PRESSURE_THRESHOLD_PA) -> Column:
    """Strict threshold; NaN never alerts (Spark orders NaN above every number)."""
    return pressure.isNotNull() & ~F.isnan(pressure) & (pressure > F.lit(limit))


def pressure_breaches(readings: DataFrame, limit: float = PRESSURE_THRESHOLD_PA) -> DataFrame:
    """Readings whose pressure exceeds the limit; NULL sensor ids excluded.

    ``readings`` are those of ``decode.alert_readings``, or rows with a
    ``values`` text.
    """
    if "pressure" not in readings.columns:
        readings = readings.withColumn("pressure", pressure_of("values"))
    return readings.where(breach(F.col("pressure"), limit) & F.col("sensor_id").isNotNull())


def _place(readings: DataFrame, col: str) -> tuple[Column, Column]:
    """A coordinate as JSON and as text: the number, or what stood for it."""
    text = F.col(f"{col}_text") if f"{col}_text" in readings.columns else F.lit(None).cast("string")
    number = F.col(col).cast("string")
    quoted = F.regexp_extract(F.to_json(F.array(text)), r"^\[(.*)\]$", 1)
    return F.coalesce(number, F.when(text.isNotNull(), quoted), F.lit("null")), F.coalesce(number, text, F.lit("None"))


def pressure_alerts(readings: DataFrame, dim_sensors, dim_customers: DataFrame | None,
                    time_col: str = "timestamp", limit: float = PRESSURE_THRESHOLD_PA) -> DataFrame:
    """Every breach is its own alert (an incident timeline, no dedup).

    Customer context comes from the sensors INNER customers registry; a
    sensor without it gets customer 'Unknown'. Adds ``message`` (the
    notification text) beside the alert-log columns. ``dim_sensors`` may be
    a ``Registry`` (then ``dim_customers`` is unused).
    """
    b = customer_lookup(pressure_breaches(readings, limit), dim_sensors, dim_customers)
    b = (b.withColumn("customer_name", F.coalesce(F.col("customer_name"), F.lit(UNKNOWN)))
          .withColumn("region", F.coalesce(F.col("customer_region"), F.lit(UNKNOWN))))
    (lat_json, lat_text), (lon_json, lon_text) = _place(b, "latitude"), _place(b, "longitude")
    head = F.to_json(F.struct(F.col("pressure"), F.lit(limit).alias("threshold")))
    tail = F.to_json(F.struct("customer_id", "customer_name", "region"), {"ignoreNullFields": "false"})
    payload = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"latitude":'), lat_json,
                       F.lit(',"longitude":'), lon_json, F.lit(","), F.regexp_replace(tail, r"^\{", ""))
    message = F.format_string(PRESSURE_MESSAGE, F.col("sensor_id").cast("string"), F.col("pressure"), F.lit(limit),
                              F.col("customer_name"), F.col("region"), lat_text, lon_text)
    t = F.lit(ALERT_PRESSURE)
    return b.select(
        alert_id(t, F.col("sensor_id"), F.col("reading_id")).alias("alert_id"),
        "sensor_id", "reading_id", t.alias("alert_type"), payload.alias("payload"),
        F.col(time_col).cast("timestamp").alias("created_at"), message.alias("message"))


def unregistered_sensors(silver: DataFrame, dim_sensors) -> DataFrame:
    """Distinct (sensor_id, country, latitude, longitude, sensor_type) with no registry row.

    ``dim_sensors`` may be a ``Registry``.
    """
    known = as_registry(dim_sensors).known_ids
    return (silver.select("sensor_id", "country", "latitude", "longitude", "sensor_type")
            .join(known, "sensor_id", "left_anti").distinct())


def unregistered_alerts(silver: DataFrame, dim_sensors, alert_log: DataFrame | None = None,
                        source: str = "gold_build") -> DataFrame:
    """One alert per unregistered sensor, ever.

    A sensor seen with several attribute sets is reported with the smallest
    (country, latitude, longitude, sensor_type); ``created_at`` is its first
    reading. Sensors already in ``alert_log`` as unregistered are skipped.
    Readings are first combined by sensor and attributes (a hash aggregate,
    map-side before the shuffle), so the choice per sensor, whose struct needs
    a sort, sees one row for each attribute set.
    """
    known = as_registry(dim_sensors).known_ids
    per_sensor = (silver.join(known, "sensor_id", "left_anti")
                  .groupBy("sensor_id", "country", "latitude", "longitude", "sensor_type")
                  .agg(F.min("ingested_at").alias("seen"))
                  .groupBy("sensor_id")
                  .agg(F.min(F.struct("country", "latitude", "longitude", "sensor_type")).alias("a"),
                       F.min("seen").alias("created_at"))
                  .select("sensor_id", "a.*", "created_at"))
    per_sensor = _not_yet_alerted(per_sensor, alert_log)
    payload = F.to_json(F.struct("sensor_id", "country", "latitude", "longitude", "sensor_type",
                                 F.lit(source).alias("source")), {"ignoreNullFields": "false"})
    t = F.lit(ALERT_UNREGISTERED)
    return per_sensor.select(
        alert_id(t, F.col("sensor_id"), F.lit(None).cast("string")).alias("alert_id"),
        "sensor_id", F.lit(None).cast("string").alias("reading_id"), t.alias("alert_type"),
        payload.alias("payload"), F.col("created_at").cast("timestamp").alias("created_at"))


def _not_yet_alerted(rows: DataFrame, alert_log: DataFrame | None) -> DataFrame:
    if alert_log is None:
        return rows
    done = alert_log.where(F.col("alert_type") == ALERT_UNREGISTERED).select("sensor_id")
    return rows.join(done, "sensor_id", "left_anti")


def first_messages(readings: DataFrame, dim_sensors, alert_log: DataFrame | None = None) -> DataFrame:
    """The ingest's form of the unregistered alert: one per sensor, ever, whose
    payload is the whole first message (of equal times, the smallest text)."""
    known = as_registry(dim_sensors).known_ids
    first = (readings.join(known, "sensor_id", "left_anti").groupBy("sensor_id")
             .agg(F.min(F.struct("timestamp", "message_text")).alias("m")))
    t = F.lit(ALERT_UNREGISTERED)
    return _not_yet_alerted(first, alert_log).select(
        alert_id(t, F.col("sensor_id"), F.lit(None).cast("string")).alias("alert_id"),
        "sensor_id", F.lit(None).cast("string").alias("reading_id"), t.alias("alert_type"),
        F.col("m.message_text").alias("payload"), F.col("m.timestamp").cast("timestamp").alias("created_at"))


def alert_detail(alert_log: DataFrame) -> DataFrame:
    """Feed line per alert: pressure/customer for breaches, sensor type otherwise."""
    p = F.col("payload")
    detail = F.when(
        F.col("alert_type") == ALERT_PRESSURE,
        F.concat(F.lit("pressure="), F.coalesce(F.get_json_object(p, "$.pressure"), F.lit("?")),
                 F.lit("Pa  customer="),
                 F.coalesce(F.get_json_object(p, "$.customer_name"), F.lit(UNKNOWN))),
    ).otherwise(F.concat(F.lit("sensor_type="), F.coalesce(F.get_json_object(p, "$.sensor_type"), F.lit("?"))))
    return alert_log.withColumn("detail", detail)


def alert_feed(alert_log: DataFrame, since_created_at=None, since_id=None) -> DataFrame:
    """Alerts after a high-water mark (created_at, alert_id), oldest first."""
    feed = alert_log
    if since_created_at is not None:
        ts = F.lit(since_created_at).cast("timestamp")
        after = F.col("created_at") > ts
        if since_id is not None:
            after = after | ((F.col("created_at") == ts) & (F.col("alert_id") > F.lit(since_id)))
        feed = feed.where(after)
    return alert_detail(feed).orderBy("created_at", "alert_id")


LOG_DAY = "log_day"


def write_log_by_day(alert_log: DataFrame, path: str, mode: str = "append") -> None:
    """The alert log stored by the day of its alerts."""
    (alert_log.withColumn(LOG_DAY, F.date_format("created_at", "yyyy-MM-dd")).hint("rebalance", LOG_DAY)
     .write.mode(mode).partitionBy(LOG_DAY).parquet(path))


def read_log_by_day(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType(ALERT_LOG.fields + [T.StructField(LOG_DAY, T.StringType())])).parquet(path)


def log_days(spark: SparkSession, path: str) -> list[str]:
    """Days that the stored log has folders for, from one listing."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LOG_DAY}=*")
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(glob) or [])


def feed_from(spark: SparkSession, path: str, since_created_at=None, since_id=None) -> DataFrame:
    """``alert_feed`` over the log stored by day: the cursor's day prunes the
    folders before it."""
    log = read_log_by_day(spark, path)
    if since_created_at is not None:
        day = F.date_format(F.lit(since_created_at).cast("timestamp"), "yyyy-MM-dd")
        log = log.where(F.col(LOG_DAY) >= day)
    return alert_feed(log, since_created_at, since_id).drop(LOG_DAY)


def high_water_by_day(spark: SparkSession, path: str) -> DataFrame:
    """``feed_high_water`` from the newest day's folder alone."""
    return feed_high_water(read_log_by_day(spark, path).where(F.col(LOG_DAY).isin(log_days(spark, path)[-1:])))


def latest_from(spark: SparkSession, path: str, n: int = FEED_WINDOW_ROWS) -> DataFrame:
    """``latest_alerts`` from the newest days only: days are taken from the
    back, twice as many each time, until they hold ``n`` alerts."""
    days, taken = log_days(spark, path), 1
    while True:
        log = read_log_by_day(spark, path).where(F.col(LOG_DAY).isin(days[-taken:]))
        if taken >= len(days) or log.limit(n).count() == n:
            return latest_alerts(log, n).drop(LOG_DAY)
        taken *= 2


def feed_high_water(alert_log: DataFrame) -> DataFrame:
    """One-row frame: latest created_at, or the epoch when the log is empty."""
    return alert_log.agg(F.coalesce(F.max("created_at"), F.lit("1970-01-01 00:00:00").cast("timestamp")).alias("created_at"))


def latest_alerts(alert_log: DataFrame, n: int = FEED_WINDOW_ROWS) -> DataFrame:
    """The rolling display: newest ``n`` alerts (a top-k, planned as TakeOrderedAndProject)."""
    order = [F.col("created_at").desc(), F.col("alert_type").desc(), F.col("sensor_id").desc(),
             F.col("reading_id").desc_nulls_last(), F.col("alert_id").desc()]
    return alert_detail(alert_log).orderBy(*order).limit(n)

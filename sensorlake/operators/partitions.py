"""Hour partitions of bronze: layout, completion status, marker back-fill, readiness.

A partition-status table (one row per closed hour) replaces marker files;
every function here works on the distinct partition values, a frame the size
of the number of hours, never on driver-side listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.constants import MARKER_LOOKBACK_HOURS
from sensorlake.schemas import BRONZE, PARTITION_COLUMNS

LAYOUT = r".*/year=\d{4}/month=\d{2}/day=\d{2}/hour=\d{2}/[^/]+\.parquet$"


def write_bronze(bronze: DataFrame, path: str, mode: str = "append") -> str:
    """Hive layout year=YYYY/month=MM/day=DD/hour=HH, Snappy Parquet.

    The ``rebalance`` hint shuffles rows by hour so each hour is written by
    few tasks; AQE splits a hot hour over several tasks and coalesces small
    ones, so neither skew nor a file per (task, hour) pair occurs.
    """
    bronze.hint("rebalance", *PARTITION_COLUMNS).write.mode(mode).partitionBy(*PARTITION_COLUMNS).parquet(path)
    return path


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Explicit schema keeps partition values as zero-padded strings."""
    return spark.read.schema(BRONZE).option("basePath", path).parquet(path)


def hour_start(year="year", month="month", day="day", hour="hour") -> F.Column:
    return F.to_timestamp(F.concat_ws("-", F.col(year), F.col(month), F.col(day), F.col(hour)), "yyyy-MM-dd-HH")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of the Parquet files under ``root``: a listing only (the
    content column of the binary source is pruned, so no file is opened)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))


HOUR_FOLDERS = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/hour=(\d{2})/[^/]+$"


def with_hour(files: DataFrame) -> DataFrame:
    """The files of the hour layout, with the partition values of their paths."""
    return files.where(F.col("path").rlike(HOUR_FOLDERS)).select(
        "*", *[F.regexp_extract("path", HOUR_FOLDERS, i + 1).alias(c) for i, c in enumerate(PARTITION_COLUMNS)])


def listed_hours(spark: SparkSession, root: str) -> DataFrame:
    """The hours that hold files, from the listing: no file of bronze is read.
    It takes the place of ``bronze`` in the functions below."""
    return with_hour(list_files(spark, root)).select(*PARTITION_COLUMNS).distinct()


def partitions(bronze: DataFrame) -> DataFrame:
    """Distinct hour partitions holding data (has_data = true)."""
    return (bronze.select(*PARTITION_COLUMNS).distinct()
            .withColumn("has_data", F.lit(True)))


def rollover_status(bronze: DataFrame, upto) -> DataFrame:
    """Markers a live consumer writes: every hour with data before the hour of
    ``upto`` is closed at the end of that hour."""
    p = partitions(bronze).withColumn("_start", hour_start())
    return (p.where(F.col("_start") < F.date_trunc("hour", F.lit(upto).cast("timestamp")))
            .select(*PARTITION_COLUMNS, "has_data",
                    (F.col("_start") + F.expr("INTERVAL 1 HOUR")).alias("closed_at")))


def missing_markers(bronze: DataFrame, status: DataFrame, now,
                    lookback_hours: int = MARKER_LOOKBACK_HOURS) -> DataFrame:
    """Closed hours in the look-back with data but no status row; the current
    hour is never touched."""
    now_hour = F.date_trunc("hour", F.lit(now).cast("timestamp"))
    p = partitions(bronze).withColumn("_start", hour_start())
    window = (p["_start"] < now_hour) & (p["_start"] >= now_hour - F.make_dt_interval(hours=F.lit(lookback_hours)))
    return (p.where(window).join(status.select(*PARTITION_COLUMNS), PARTITION_COLUMNS, "left_anti")
            .select(*PARTITION_COLUMNS, "has_data", F.lit(now).cast("timestamp").alias("closed_at")))


def backfill(bronze: DataFrame, status: DataFrame, now, lookback_hours: int = MARKER_LOOKBACK_HOURS) -> DataFrame:
    """Status table after the start-up back-fill (idempotent)."""
    return status.unionByName(missing_markers(bronze, status, now, lookback_hours))


def ready_hours(bronze: DataFrame, status: DataFrame) -> DataFrame:
    """Hours a refresh may process: a status row exists and data is present."""
    return status.join(partitions(bronze).select(*PARTITION_COLUMNS), PARTITION_COLUMNS, "left_semi")


def file_manifest(spark: SparkSession, root: str, now) -> DataFrame:
    """Parquet files of the current and previous hour, with size and short key,
    from the listing."""
    now_ts = F.lit(now).cast("timestamp")
    hours = [F.date_trunc("hour", now_ts), F.date_trunc("hour", now_ts) - F.expr("INTERVAL 1 HOUR")]
    f = with_hour(list_files(spark, root)).where(hour_start().isin(*hours))
    parts = F.split("path", "/")
    short = F.concat_ws("/", *[F.element_at(parts, -i) for i in (4, 3, 2, 1)])
    return f.select(F.col("path").alias("file_path"), short.alias("short_key"),
                    F.round(F.col("length") / 1024, 1).alias("size_kb"), *PARTITION_COLUMNS)


def layout_violations(spark: SparkSession, root: str) -> DataFrame:
    """Files whose path does not follow the zero-padded Hive layout."""
    return list_files(spark, root).select(F.col("path").alias("file_path")).where(~F.col("file_path").rlike(LAYOUT))

"""Incremental maintenance of silver and the marts on Parquet.

Contract: an incremental run gives the same tables as a full rebuild.
- The increment is the bronze *files* that no earlier run has processed: a log
  of file names is anti-joined to the file listing. Event times play no part,
  so late deliveries, skewed clocks and far-future stamps lose nothing.
- Every *grain touched* is recomputed whole: silver hours that hold a new
  reading or another copy of it, and the mart days of those hours, whether
  they gained or lost a reading. Grains left empty are removed.
- The earliest copy of a reading wins, by one order that both the full build
  and the merge use, wherever and whenever the copy arrived.
- Results are staged to a fresh path first (lineage cut, and the target is
  never read and overwritten by one job). A merge overwrites only touched
  partitions; a full build is written aside and swapped in.
- The file log is written last, so that a run that breaks off is done again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.operators import gold
from sensorlake.operators.joins import bounded_broadcast, enrich
from sensorlake.operators.partitions import list_files
from sensorlake.operators.silver import build_silver, earliest_per_reading
from sensorlake.schemas import BRONZE, SILVER
from sensorlake.session import path_exists, remove_path, rename_path, scratch_path, sized_for
from sensorlake.sources.tables import stage_table, staged_path

# Storage partitions of silver, and the grain an incremental run recomputes:
# an hourly run rewrites the hours it touches, not the whole current day.
SILVER_PARTITIONS = ["day", "hour"]
SILVER_STORED = T.StructType(SILVER.fields + [T.StructField(c, T.StringType()) for c in SILVER_PARTITIONS])
MART_PARTITION = "part_day"
FILE_LOG = T.StructType([T.StructField("path", T.StringType())])


# ------------------------------------------------------------- the increment


def file_log(silver_path: str) -> str:
    return silver_path.rstrip("/") + "__files"


def new_files(spark: SparkSession, bronze_root: str, log_path: str) -> DataFrame:
    """Files that the log does not hold, staged so that the run and the log
    entry it writes at its end agree."""
    files = list_files(spark, bronze_root).select("path")
    if path_exists(spark, log_path):
        files = files.join(spark.read.schema(FILE_LOG).parquet(log_path), "path", "left_anti")
    return stage_table(files, "new_files")


def read_files_of(spark: SparkSession, bronze_root: str, files: DataFrame) -> DataFrame:
    """Bronze rows of the named files, with their partition columns. The names
    (one per file of an hourly increment) go through the driver, as the names
    of any scan's files do."""
    from sensorlake.sources.tables import read_files
    paths = [r["path"] for r in files.collect()]
    return read_files(spark, paths, BRONZE, bronze_root) if paths else spark.createDataFrame([], BRONZE)


# ------------------------------------------------------------------ partitions


def replace_partitions(spark: SparkSession, fresh: DataFrame, target: str, partition_cols: list[str]) -> None:
    """Overwrite only the partitions of ``target`` that ``fresh`` has rows for.

    ``fresh`` is staged first if it isn't yet. The staging copy is deleted once
    the overwrite has committed, so repeated merges do not leave a copy of every
    rewritten partition behind.
    """
    staged = fresh if hasattr(fresh, "_staged_path") else stage_table(fresh, "staging")
    (staged.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(target))
    remove_path(spark, staged_path(staged))


def replace_table(spark: SparkSession, fresh: DataFrame, target: str, partition_cols: list[str]) -> None:
    """Write ``fresh`` beside ``target`` and swap it in, so a run that breaks
    off leaves the old table or the new one, never half of one."""
    aside = f"{target.rstrip('/')}__new-{uuid.uuid4().hex[:8]}"
    old = f"{target.rstrip('/')}__old-{uuid.uuid4().hex[:8]}"
    fresh.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols).parquet(aside)
    if path_exists(spark, target):
        rename_path(spark, target, old)
    rename_path(spark, aside, target)
    if path_exists(spark, old):
        remove_path(spark, old)


def clear_partitions(spark: SparkSession, root: str, keys: DataFrame) -> None:
    """Delete the partition folders named by ``keys`` (touched grains that have
    no row any more; a dynamic overwrite would leave their old rows)."""
    for row in keys.collect():  # one row for each emptied grain
        remove_path(spark, root.rstrip("/") + "/" + "/".join(f"{c}={row[c]}" for c in keys.columns))


# ----------------------------------------------------------------------- silver


def with_partitions(df: DataFrame) -> DataFrame:
    """Silver rows with their storage partitions: calendar day and hour (UTC)."""
    return (df.withColumn("day", F.date_format("ingested_at", "yyyy-MM-dd"))
              .withColumn("hour", F.date_format("ingested_at", "HH")))


def read_stored_silver(spark: SparkSession, path: str) -> DataFrame:
    """Stored silver with its partition columns kept as zero-padded strings
    (an explicit schema, so "07" is not read back as the number 7)."""
    return spark.read.schema(SILVER_STORED).parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_stored_silver(spark, path).drop(*SILVER_PARTITIONS)


def of_days(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the touched days, by a predicate on the partition column with
    the days as literals: other days are not listed, let alone read."""
    return stored.where(F.col("day").isin([r["day"] for r in touched.select("day").distinct().collect()]))


def merge_silver(spark: SparkSession, rows: DataFrame, silver_path: str) -> DataFrame:
    """Merge valid silver rows into the stored table and return the touched
    (day, hour) partitions, staged.

    Rows may hold any copies, in any order and more than once: merging the same
    rows again changes nothing, so a repeated run or micro-batch is harmless.
    """
    new = stage_table(with_partitions(earliest_per_reading(rows)), "silver_increment")
    touched = new.select(*SILVER_PARTITIONS)
    exists = path_exists(spark, silver_path)
    if exists:
        target = read_stored_silver(spark, silver_path)
        ids = bounded_broadcast(new.select("reading_id").distinct())
        # hours that hold another copy of a new reading: no window on how far
        # back. One scan of three columns; with the ids broadcast it is a
        # map-side filter and the stored table is never shuffled.
        older = target.select("reading_id", *SILVER_PARTITIONS).join(ids, "reading_id", "left_semi")
        touched = touched.union(older.select(*SILVER_PARTITIONS))
    touched = stage_table(touched.distinct(), "silver_touched")
    if exists:
        affected = of_days(target, touched).join(bounded_broadcast(touched), SILVER_PARTITIONS, "left_semi")
        merged = earliest_per_reading(affected.unionByName(new).drop(*SILVER_PARTITIONS))
        merged = stage_table(with_partitions(merged), "silver_merged")
        # clear first: a crash before the overwrite is repaired by the next run,
        # as a reading that left an emptied hour is among the rows of this one
        kept = merged.select(*SILVER_PARTITIONS).distinct()
        clear_partitions(spark, silver_path, touched.join(kept, SILVER_PARTITIONS, "left_anti"))
        replace_partitions(spark, merged, silver_path, SILVER_PARTITIONS)
        remove_path(spark, staged_path(new))
    else:
        replace_partitions(spark, new, silver_path, SILVER_PARTITIONS)
    return touched


# ------------------------------------------------------------------------ marts


def refresh_mart(spark: SparkSession, name: str, silver_path: str, touched: DataFrame | None,
                 dim_sensors, dim_customers: DataFrame | None, mart_path: str) -> None:
    """Recompute every mart partition (calendar day) of the ``touched`` silver
    partitions; all of them when ``touched`` is None or the mart is new.

    The recompute grain is the storage partition, never finer: a day that
    gains or loses one reading is rebuilt from all of that day's silver rows
    (read by partition, other days are pruned), and removed when none is left.
    The mart then has the columns of its model, whatever it was stored with.
    """
    unit = "hour" if name == "pm25_by_country_hour" else "day"
    source = read_stored_silver(spark, silver_path)
    full = touched is None or not path_exists(spark, mart_path)
    if not full:
        source, days = of_days(source, touched), touched.select("day").distinct()
    source = source.drop(*SILVER_PARTITIONS)
    mart = gold.MARTS[name](enrich(source, dim_sensors, dim_customers))
    mart = mart.withColumn(MART_PARTITION, F.date_format(unit, "yyyy-MM-dd"))
    if full:
        replace_table(spark, mart, mart_path, [MART_PARTITION])
        return
    if list_files(spark, mart_path).limit(1).count():  # a mart without rows has no columns to follow
        stored = spark.read.option("mergeSchema", "true").parquet(mart_path)
        model = T.StructType([f for f in mart.schema if f.name != MART_PARTITION])
        if {(f.name, f.dataType) for f in stored.schema if f.name != MART_PARTITION} != {(f.name, f.dataType) for f in model}:
            followed = sync_columns(stored, model).withColumn(MART_PARTITION, F.date_format(unit, "yyyy-MM-dd"))
            replace_table(spark, followed, mart_path, [MART_PARTITION])
    mart = stage_table(mart, "mart_days")
    left = mart.select(F.col(MART_PARTITION).alias("day")).distinct()
    clear_partitions(spark, mart_path, days.join(left, "day", "left_anti").withColumnRenamed("day", MART_PARTITION))
    replace_partitions(spark, mart, mart_path, [MART_PARTITION])


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A stored mart. One without rows has no file to read columns from, which
    is an error here as for any Parquet folder."""
    return spark.read.parquet(path).drop(MART_PARTITION)


def sync_columns(df: DataFrame, model: T.StructType) -> DataFrame:
    """Follow the model's columns: add missing ones as typed NULLs, drop extras."""
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in model.fields])


# ---------------------------------------------------------------------- refresh


def refresh(spark: SparkSession, bronze_root: str, silver_path: str, dim_sensors=None,
            dim_customers: DataFrame | None = None, mart_paths: dict[str, str] | None = None,
            full_refresh: bool = False) -> None:
    """One run of the pipeline behind bronze: silver, then the marts.

    Full when asked or when there is no silver yet, else the files not yet
    processed. Scan splits and shuffle partitions are set for the bytes that
    this run reads. The log of files is written when all tables are done: what
    a run that broke off had changed is changed to the same by the next.
    """
    log = file_log(silver_path)
    full = full_refresh or not path_exists(spark, silver_path)
    files = stage_table(list_files(spark, bronze_root).select("path"), "new_files") if full else new_files(spark, bronze_root, log)
    with sized_for(spark, [bronze_root] if full else [r["path"] for r in files.collect()]):
        touched = None
        if full:
            replace_table(spark, with_partitions(build_silver(spark.read.schema(BRONZE).parquet(bronze_root))),
                          silver_path, SILVER_PARTITIONS)
        else:
            rows = build_silver(read_files_of(spark, bronze_root, files), dedup=False)
            touched = merge_silver(spark, rows, silver_path)
        for name, path in (mart_paths or {}).items():
            refresh_mart(spark, name, silver_path, touched, dim_sensors, dim_customers, path)
        if full:
            aside = scratch_path(spark, "file_log")
            files.write.parquet(aside)
            if path_exists(spark, log):
                remove_path(spark, log)
            rename_path(spark, aside, log)
        else:
            files.write.mode("append").parquet(log)
    for done in [files] + ([touched] if touched is not None else []):
        remove_path(spark, staged_path(done))

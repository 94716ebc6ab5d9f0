"""Create-if-missing table folders, multi-path reads, and the registry store.

The registry (sensors and customers) lives in a relational database in the
original set-up. Here it is a pair of Parquet tables on shared storage:
created if missing, replaced in bulk, read back with explicit column lists.
``sources/jdbc.py`` is the same store over a JDBC URL when one is configured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sensorlake.schemas import DIM_CUSTOMERS, DIM_SENSORS
from sensorlake.session import path_exists


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, seed: DataFrame | None = None) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS: write an empty (or seeded) Parquet table
    only when nothing is there yet, then return the table."""
    if not path_exists(spark, path):
        df = seed if seed is not None else spark.createDataFrame([], schema)
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_files(spark: SparkSession, paths: list[str], schema: T.StructType, root: str) -> DataFrame:
    """UNION of many files/folders in one scan (one task per split, not per
    file); partition columns come from the folders between ``root`` and them."""
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def write_registry(sensors: DataFrame, customers: DataFrame, root: str) -> None:
    """Create both registry tables if missing, then replace their contents in
    bulk (one write job per table, never one statement per row).

    The inputs must not be scans of ``root`` itself (a job never reads and
    overwrites the same path): stage an upserted registry elsewhere first.
    """
    spark = sensors.sparkSession
    for name, df, schema in (("dim_sensors", sensors, DIM_SENSORS), ("customers", customers, DIM_CUSTOMERS)):
        ensure_table(spark, f"{root}/{name}", schema)
        df.select(*_columns(schema)).write.mode("overwrite").parquet(f"{root}/{name}")


def read_registry(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Registry scan with explicit column lists (only these columns are read)."""
    sensors = spark.read.schema(DIM_SENSORS).parquet(f"{root}/dim_sensors").select(*_columns(DIM_SENSORS))
    customers = spark.read.schema(DIM_CUSTOMERS).parquet(f"{root}/customers").select(*_columns(DIM_CUSTOMERS))
    return sensors, customers


def staged_path(df: DataFrame) -> str:
    """Folder of a frame returned by ``stage_table``."""
    return df._staged_path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint root and
    scan it back: several consumers then read the stored rows (with column
    pruning) instead of each recomputing the plan, and lineage is cut, so a
    lost executor costs a re-read, not a recompute from raw input."""
    from sensorlake.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged

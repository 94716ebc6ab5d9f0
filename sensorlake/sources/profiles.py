"""Profile table write/read (Parquet, map column kept as a Parquet map)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.schemas import PROFILE
from sensorlake.session import path_exists


def write_profiles(profile: DataFrame, path: str) -> str:
    profile.write.mode("overwrite").parquet(path)
    return path


def load_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Read stored profiles; a missing table is an error, not an empty frame."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no profiles at {path}; build them first")
    return spark.read.schema(PROFILE).parquet(path)

"""Device registry: snapshot -> profiles -> dim_sensors, and dimension merges.

Everything is row-local or one aggregation per sensor: the latest entry is a
``max_by`` (combined map-side), measurement ranges are built with array
higher-order functions inside the row, so no step shuffles more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.constants import (ASIA_PACIFIC_BOX, EUROPE_COUNTRIES, NORTH_AMERICA_BOX,
                                  PROFILE_SAMPLE_SIZE, REGION_CUSTOMERS, SEED_CUSTOMERS)
from sensorlake.operators.joins import bounded_broadcast
from sensorlake.schemas import DIM_CUSTOMERS
from sensorlake.session import remove_path
from sensorlake.sources.tables import stage_table, staged_path

DIM_SENSOR_COLUMNS = ["sensor_id", "sensor_type", "latitude", "longitude", "country", "region", "customer_id"]


def latest_per_sensor(snapshot: DataFrame) -> DataFrame:
    """Newest entry per nested sensor.id (string timestamp, missing = '');
    ties go to the higher top-level id; entries without sensor.id dropped."""
    order = F.struct(F.coalesce(F.col("timestamp"), F.lit("")).alias("t"), F.col("id").alias("i"))
    entry = F.struct(*[F.col(c) for c in snapshot.columns])
    return (snapshot.where(F.col("sensor.id").isNotNull())
            .groupBy(F.col("sensor.id").alias("sensor_id"))
            .agg(F.max_by(entry, order).alias("e"))
            .select("e.*"))


def valid_profile(entry_lat: Column, entry_lon: Column) -> Column:
    lat, lon = entry_lat.try_cast("double"), entry_lon.try_cast("double")
    return (F.col("sensor.id").isNotNull() & (F.size(F.coalesce(F.col("sensordatavalues"), F.array())) > 0)
            & lat.between(-90, 90) & lon.between(-180, 180))


def value_ranges(values: Column) -> Column:
    """value_type -> {mean, std}: non-numeric values skipped, a missing value
    counts as 0, empty names skipped, the last duplicate wins; std is
    max(5 % of the value, 0.5)."""
    parsed = F.transform(values, lambda e: F.struct(
        e["value_type"].alias("k"),
        F.when(e["value"].isNull(), F.lit(0.0)).otherwise(e["value"].try_cast("double")).alias("v")))
    ok = F.filter(parsed, lambda x: x["k"].isNotNull() & (x["k"] != "") & x["v"].isNotNull())
    # each name once, with its last value: sorted by name and place, the entry
    # before another name (n log n in the row's entries, not n squared)
    placed = F.array_sort(F.transform(ok, lambda x, i: F.struct(x["k"].alias("k"), i.alias("i"), x["v"].alias("v"))))
    last = F.filter(placed, lambda x, i: ~F.coalesce(F.get(placed, i + 1)["k"] == x["k"], F.lit(False)))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(
        x["k"], F.struct(x["v"].alias("mean"), F.greatest(x["v"] * 0.05, F.lit(0.5)).alias("std")))))


def profiles(snapshot: DataFrame) -> DataFrame:
    """Deduplicate (before validation, as the source does), validate, project."""
    latest = latest_per_sensor(snapshot)
    lat, lon = F.col("location.latitude"), F.col("location.longitude")
    return (latest.where(valid_profile(lat, lon))
            .select(F.col("sensor.id").alias("id"),
                    F.coalesce(F.col("sensor.sensor_type.name"), F.lit("unknown")).alias("sensor_type"),
                    lat.try_cast("double").alias("latitude"), lon.try_cast("double").alias("longitude"),
                    F.coalesce(F.col("location.country"), F.lit("")).alias("country"),
                    value_ranges(F.col("sensordatavalues")).alias("value_ranges")))


def flat_ranges(profile: DataFrame) -> DataFrame:
    """One row per (profile, measurement) for inspection and comparison."""
    return profile.select("id", "sensor_type", "latitude", "longitude", "country",
                          F.explode_outer("value_ranges").alias("value_type", "r")) \
                  .select("id", "sensor_type", "latitude", "longitude", "country", "value_type",
                          F.col("r.mean").alias("mean"), F.col("r.std").alias("std"))


def sample(df: DataFrame, k: int = PROFILE_SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """Exactly min(k, n) rows, uniformly without replacement.

    Ordering by a random key under a limit is planned as a top-k
    (TakeOrderedAndProject): each task keeps k rows, so no global sort.
    """
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(k).drop("_r")


def _in_box(box: dict) -> Column:
    (lo_lon, hi_lon), (lo_lat, hi_lat) = box["lon"], box["lat"]
    return F.col("longitude").between(lo_lon, hi_lon) & F.col("latitude").between(lo_lat, hi_lat)


def assign_region() -> Column:
    return (F.when(F.col("country").isin(*EUROPE_COUNTRIES), F.lit("Europe"))
            .when(_in_box(NORTH_AMERICA_BOX), F.lit("North America"))
            .when(_in_box(ASIA_PACIFIC_BOX), F.lit("Asia-Pacific"))
            .otherwise(F.lit("Other")))


def assign_customer(sensor_id: Column, region: Column) -> Column:
    """pool[sensor_id mod len(pool)] with a non-negative modulo; unknown region -> Other."""
    pools = F.create_map(*[x for name, ids in REGION_CUSTOMERS.items()
                           for x in (F.lit(name), F.array(*[F.lit(i) for i in ids]))])
    pool = F.coalesce(F.element_at(pools, region), F.array(*[F.lit(i) for i in REGION_CUSTOMERS["Other"]]))
    return F.element_at(pool, (F.pmod(sensor_id, F.size(pool)) + 1).cast("int")).cast("int")


def dim_sensors_from_profiles(profile: DataFrame) -> DataFrame:
    return (profile.withColumn("region", assign_region())
            .select(F.col("id").alias("sensor_id"), "sensor_type", "latitude", "longitude", "country",
                    "region", assign_customer(F.col("id"), F.col("region")).alias("customer_id")))


def seed_customers(spark: SparkSession) -> DataFrame:
    """The fixed customer rows every registry starts with."""
    return spark.createDataFrame(SEED_CUSTOMERS, DIM_CUSTOMERS)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE: matched keys take the source row, new keys are inserted, nothing deleted.

    Null-safe on the keys; the source is first reduced to one row per key.
    Target rows whose key the source carries are removed by an anti join
    (shuffled on the key; a small source is broadcast after a size check).
    """
    src = first_per_key(source, keys)
    src_keys = bounded_broadcast(src.select(*[F.col(k).alias(f"_s_{k}") for k in keys]))
    cond = [target[k].eqNullSafe(src_keys[f"_s_{k}"]) for k in keys]
    kept = target.join(src_keys, cond, "left_anti")
    return kept.unionByName(src.select(*target.columns))


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One deterministic row per key: the smallest over all other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns))


class BucketedTable:
    """A keyed table that is merged in place: stored by hash bucket of its key,
    an upsert reads and rewrites only the buckets of its rows' keys."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def create(self, df: DataFrame) -> None:
        self._bucketed(df).repartition("bucket").write.partitionBy("bucket").parquet(self.path)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        return (df if buckets is None else df.where(F.col("bucket").isin(buckets))).drop("bucket")

    def upsert(self, source: DataFrame) -> None:
        """As ``upsert``. The merged buckets are staged, so the table is never
        read and overwritten by one job; a run that breaks off while buckets
        are swapped is repaired by doing it again."""
        source = stage_table(first_per_key(source, self.keys), "upsert_source")
        touched = [r["bucket"] for r in self._bucketed(source).select("bucket").distinct().collect()]  # at most ``buckets``
        if touched:
            merged = stage_table(self._bucketed(upsert(self.read(touched), source, self.keys)), "upserted")
            (merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))
            remove_path(self.spark, staged_path(merged))
        remove_path(self.spark, staged_path(source))


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append only rows whose key is not present yet (ON CONFLICT DO NOTHING)."""
    src = first_per_key(new, keys)
    fresh = src.join(target.select(*[F.col(k) for k in keys]), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))

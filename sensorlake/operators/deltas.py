"""Silver and the marts kept by deltas: a run reads and writes what changed.

``DeltaStore`` keeps, under one root:

- ``silver``: day / hour / batch. A run adds its own batch to the hours it has
  new readings for; only the batch that holds a copy which a new one replaces
  is written anew.
- ``index``: where each reading is stored, by hash bucket of its id; every run
  appends its winners, the latest entry of an id counts. A run reads the
  buckets of its own ids. A redelivery that comes later than the stored copy is
  settled by the index alone.
- ``changes``: the run's rows added (+1) and removed (-1), written before
  anything else is touched. A run that breaks off is done again from them, and
  every later step writes the same batch folders again.
- ``state`` of each mart: signed sums and counts for each grain and batch, and
  a table of signed value counts from which minima, maxima and distinct counts
  follow. A run appends the aggregates of its changes; reading a mart adds the
  batches up; no silver is read. ``compact`` adds them up for good.

Marts carry the registry's names. When the registry changes, they are built
anew from silver once (a fingerprint is kept with each run).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.scalar import HUGE
from sensorlake.operators.gold import ACTIVITY_KEYS, PM25_KEYS, TEMPERATURE_KEYS
from sensorlake.operators.joins import Registry, bounded_broadcast, enrich
from sensorlake.operators.merge import clear_partitions, replace_partitions, replace_table
from sensorlake.operators.silver import COPY_ORDER, build_silver, earliest_per_reading
from sensorlake.schemas import BRONZE, SILVER
from sensorlake.session import path_exists, remove_path, sized_for
from sensorlake.sources.listing import FileLog
from sensorlake.sources.tables import read_files, stage_table, staged_path

PLACE = ["day", "hour", "batch"]
STORED = T.StructType(SILVER.fields + [T.StructField("day", T.StringType()), T.StructField("hour", T.StringType()), T.StructField("batch", T.LongType())])
CHANGES = T.StructType([T.StructField("sign", T.IntegerType())] + STORED.fields)
INDEX = T.StructType([T.StructField("reading_id", T.StringType()), T.StructField("ingested_at", T.TimestampType()), T.StructField("day", T.StringType()),
                      T.StructField("hour", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])
DONE = T.StructType([T.StructField("batch", T.LongType()), T.StructField("registry", T.StringType())])
PLAIN = T.DecimalType(28, 6)


@dataclass(frozen=True)
class DeltaMart:
    """A mart as retractable aggregates: rows where ``present`` is not null,
    by ``unit`` of time and ``keys``; averages and extremes are result column
    -> measurement, ``distinct`` is result column -> counted column."""
    unit: str
    keys: tuple
    count: str
    present: str | None = None
    averages: dict = field(default_factory=dict)
    highest: dict = field(default_factory=dict)
    lowest: dict = field(default_factory=dict)
    distinct: dict = field(default_factory=dict)
    enriched: bool = True

    @property
    def grain(self) -> list[str]:
        return [self.unit, *self.keys]

    @property
    def summed(self) -> list[str]:
        return sorted(set(self.averages.values()))

    def state_of(self, changes: DataFrame) -> DataFrame:
        """Signed count of rows, and of each averaged column the signed count
        and exact sum of its plain values; partial sums are taken map-side."""
        sign = F.col("sign")
        aggs = [F.sum(sign).cast("long").alias("n")]
        for c in self.summed:
            exact = F.when(plain(c), F.col(c).cast(PLAIN))
            aggs += [F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign)), F.lit(0)).cast("long").alias(f"n_{c}"),
                     F.coalesce(F.sum(F.when(sign > 0, exact).otherwise(-exact)), F.lit(0)).cast("decimal(38,6)").alias(f"sum_{c}")]
        return self.grained(changes).groupBy(*self.grain, "part_day").agg(*aggs)

    def values_of(self, changes: DataFrame) -> DataFrame:
        """Signed counts of the values that no sum holds: for extremes the
        rounded values, for averages those that are not plain, and the members
        of distinct counts. Values that cancel out leave no row."""
        none, items = F.lit(None), []
        item = lambda name, when, value, member: F.when(when, F.struct(F.lit(name).alias("item"), value.cast("double").alias("value"), member.cast("string").alias("member")))
        for c in sorted({*self.highest.values(), *self.lowest.values()}):
            items.append(item(c, F.col(c).isNotNull(), F.round(c, 3), none))
        for c in self.summed:
            items.append(item(f"~{c}", F.col(c).isNotNull() & ~plain(c), F.col(c), none))
        for c in sorted(set(self.distinct.values())):
            items.append(item(c, F.col(c).isNotNull(), none, F.col(c)))
        if not items:
            items = [item("", F.lit(False), none, none)]
        rows = self.grained(changes).select(*self.grain, "part_day", "sign", F.inline(F.filter(F.array(*items), lambda x: x.isNotNull())))
        return rows.groupBy(*self.grain, "part_day", "item", "value", "member").agg(F.sum("sign").cast("long").alias("n")).where("n <> 0")

    def grained(self, changes: DataFrame) -> DataFrame:
        rows = changes if self.present is None else changes.where(F.col(self.present).isNotNull())
        return rows.withColumn(self.unit, F.date_trunc(self.unit, "ingested_at")).withColumn("part_day", F.date_format(self.unit, "yyyy-MM-dd"))

    def result(self, state: DataFrame, values: DataFrame) -> DataFrame:
        """The mart from the sums of its batches. State and values meet in one
        aggregate by grain, which treats null keys as equal."""
        grain = self.grain
        sums = state.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in state.columns if c not in (*grain, "part_day", "batch")])
        left = values.groupBy(*grain, "item", "value", "member").agg(F.sum("n").alias("n")).where("n > 0")
        of = lambda c: F.when(F.col("item") == c, F.col("value"))
        found = [*[F.max(of(c)).alias(out) for out, c in self.highest.items()], *[F.min(of(c)).alias(out) for out, c in self.lowest.items()],
                 *[F.sum(of(f"~{c}") * F.col("n")).alias(f"rest_{c}") for c in self.summed], *[F.count_if(F.col("item") == c).alias(out) for out, c in self.distinct.items()]]
        left = left.groupBy(*grain).agg(*found) if found else left.select(*grain).distinct()
        names = [c for c in [*sums.columns, *left.columns] if c not in grain]
        both = sums.unionByName(left, allowMissingColumns=True).groupBy(*grain).agg(*[F.max(c).alias(c) for c in names]).where("n > 0")
        averages = [mean(F.col(f"sum_{c}"), F.col(f"rest_{c}"), F.col(f"n_{c}")).alias(out) for out, c in self.averages.items()]
        distinct = [F.coalesce(out, F.lit(0)).alias(out) for out in self.distinct]
        return both.select(*grain, F.col("n").alias(self.count), *averages, *self.highest, *self.lowest, *distinct)


def plain(c: str) -> Column:
    return F.abs(F.col(c)) < HUGE


def mean(total: Column, rest: Column, n: Column) -> Column:
    """``scalar.exact_avg`` from its parts."""
    value = F.try_divide(total.cast("double") + F.coalesce(rest, F.lit(0.0)), n)
    return F.when(F.abs(value) < 1e15, F.round(value.cast(PLAIN), 3).cast("double")).otherwise(value)


MARTS = {
    "pm25_by_country_hour": DeltaMart("hour", tuple(PM25_KEYS[1:]), "reading_count", "pm25", {"avg_pm25": "pm25", "avg_pm10": "pm10"},
                                      {"max_pm25": "pm25", "max_pm10": "pm10"}, {"min_pm25": "pm25"}),
    "temperature_by_region_day": DeltaMart("day", tuple(TEMPERATURE_KEYS[1:]), "reading_count", "temperature",
                                           {"avg_temperature": "temperature", "avg_humidity": "humidity", "avg_pressure": "pressure"},
                                           {"max_temperature": "temperature"}, {"min_temperature": "temperature"}),
    "sensor_activity_by_customer": DeltaMart("day", tuple(ACTIVITY_KEYS[1:]), "total_readings", distinct={"active_sensors": "sensor_id"}),
    "hourly": DeltaMart("hour", ("sensor_type",), "reading_count", averages={"avg_pm25": "pm25"}, enriched=False),
}


def copy_order(prefix: str = "") -> Column:
    """``COPY_ORDER`` with nulls last, as one comparable value."""
    return F.struct(*[x for c in COPY_ORDER for x in (F.col(prefix + c).isNull().alias(f"{c}_null"), F.col(prefix + c).alias(c))])


class DeltaStore:
    def __init__(self, spark: SparkSession, root: str, registry: Registry | None = None, marts: Iterable[str] = (), buckets: int = 64):
        """``buckets`` counts when the store is new; later it is what was stored."""
        self.spark, self.root, self.registry, self.marts = spark, root.rstrip("/"), registry, list(marts)
        path = f"{self.root}/buckets"
        if not path_exists(spark, path):
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(path)
        self.buckets = spark.read.schema("buckets int").parquet(path).first()["buckets"]

    # ------------------------------------------------------------- tables

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def stored_silver(self) -> DataFrame:
        return self._read("silver", STORED)

    def silver(self) -> DataFrame:
        return self.stored_silver().drop(*PLACE)

    def index_of(self, buckets: list[int]) -> DataFrame:
        """Index entries of some buckets; others are neither listed nor read."""
        return self._read("index", INDEX).where(F.col("bucket").isin(buckets))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("reading_id"), F.lit(self.buckets)).cast("int")

    def _state_schema(self, mart: str, kind: str) -> T.StructType:
        empty = self.spark.createDataFrame([], T.StructType(CHANGES.fields + [T.StructField(c, T.StringType()) for c in ("region", "customer_name")]))
        spec = MARTS[mart]
        fields = (spec.state_of(empty) if kind == "state" else spec.values_of(empty)).schema.fields
        return T.StructType([f for f in fields if f.name != "part_day"] + [T.StructField("part_day", T.StringType()), T.StructField("batch", T.LongType())])

    def mart(self, name: str, days: list[str] | None = None) -> DataFrame:
        """A mart, or some days of it (partition literals)."""
        state, values = (self._read(f"{name}/{kind}", self._state_schema(name, kind)) for kind in ("state", "values"))
        if days is not None:
            state, values = (df.where(F.col("part_day").isin(days)) for df in (state, values))
        out = MARTS[name].result(state, values)
        if name == "sensor_activity_by_customer":
            out = out.withColumn("avg_readings_per_sensor", F.round(F.try_divide(F.col("total_readings"), F.col("active_sensors")), 1))
        return out

    # ---------------------------------------------------------------- runs

    def done(self) -> DataFrame:
        return self._read("done", DONE)

    def next_batch(self) -> int:
        last = self.done().agg(F.max("batch").alias("b")).first()["b"]
        return 0 if last is None else last + 1

    def run(self, rows: DataFrame, batch: int) -> None:
        """Merge valid silver rows (copies and all) as batch ``batch``. A batch
        that is done is not done again; one that broke off goes on from its
        changes, whatever rows come with it."""
        if path_exists(self.spark, f"{self.root}/done/batch={batch}/_SUCCESS"):
            return
        path = f"{self.root}/changes/{batch}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            self.find_changes(rows, batch).write.mode("overwrite").parquet(path)
        changes = self.spark.read.schema(CHANGES).parquet(path)
        self.apply_to_silver(changes)
        self.apply_to_index(changes)
        registry = self.fingerprint()
        last = self.done().agg(F.max_by("registry", "batch").alias("r")).first()["r"]
        for name in self.marts:
            if last is not None and last != registry and MARTS[name].enriched:
                self.rebuild(name, batch)
            else:
                self.apply_to_mart(name, changes, batch)
        one = self.spark.createDataFrame([(registry,)], "registry string").coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.root}/done/batch={batch}")
        remove_path(self.spark, path)

    def refresh(self, bronze_root: str, log: FileLog | None = None) -> None:
        """One run over the landed files that no run has processed."""
        log = log or FileLog(self.spark, f"{self.root}/files")
        found = log.new_files(bronze_root)
        paths = [r["path"] for r in found.files.select("path").collect()]  # names of one increment's files
        if paths:
            with sized_for(self.spark, paths):
                self.run(build_silver(read_files(self.spark, paths, BRONZE, bronze_root), dedup=False), self.next_batch())
        log.commit(found)

    def find_changes(self, rows: DataFrame, batch: int) -> DataFrame:
        """Signed rows. The increment's ids are looked up in their buckets:
        unknown ids are added, later copies dropped, and only for copies as
        early as the stored one, or earlier, is the stored row fetched, from
        the hours the index names. Only those and the index entries found are
        staged beside the increment; a new store has none to look up."""
        day, hour = F.date_format("ingested_at", "yyyy-MM-dd"), F.date_format("ingested_at", "HH")
        new = earliest_per_reading(rows).select(*[f.name for f in SILVER.fields], day.alias("day"), hour.alias("hour"), F.lit(batch).cast("long").alias("batch"))
        plus = lambda df: df.select(F.lit(1).alias("sign"), *STORED.names)
        if not path_exists(self.spark, f"{self.root}/index"):
            return plus(new)
        new = stage_table(new, "increment")
        ids = new.select("reading_id", self.bucket().alias("bucket"))
        index = self.index_of([r["bucket"] for r in ids.select("bucket").distinct().collect()])
        known = index.join(bounded_broadcast(ids.select("reading_id")), "reading_id", "left_semi")
        entry = F.struct("ingested_at", *PLACE)
        known = stage_table(known.groupBy("reading_id").agg(F.max_by(entry, "batch").alias("at")), "known")
        added = plus(new.join(bounded_broadcast(known.select("reading_id")), "reading_id", "left_anti"))
        rivals = stage_table(new.join(known, "reading_id").where(F.col("ingested_at") <= F.col("at.ingested_at")), "rivals")
        places = rivals.select(*[F.col(f"at.{c}").alias(c) for c in PLACE]).distinct()
        stored = self.stored_silver().where(F.col("day").isin([r["day"] for r in places.select("day").distinct().collect()]))
        wanted = bounded_broadcast(rivals.select("reading_id", *[F.col(f"at.{c}").alias(c) for c in PLACE]))
        stored = stored.join(wanted, ["reading_id", *PLACE], "left_semi").select("reading_id", F.struct(*STORED.names).alias("old"))
        better = rivals.join(stored, "reading_id").where(copy_order() < copy_order("old."))
        better = stage_table(better.select(*STORED.names, "old"), "better")
        removed = better.select(F.lit(-1).alias("sign"), "old.*")
        return added.unionByName(plus(better)).unionByName(removed)

    def apply_to_silver(self, changes: DataFrame) -> None:
        """New batches of hours, and without the removed rows the batches that
        hold them. Done twice, it leaves the same."""
        spark, path = self.spark, f"{self.root}/silver"
        added = changes.where("sign > 0").drop("sign")
        (added.hint("rebalance", *PLACE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(path))
        removed = changes.where("sign < 0").select("reading_id", *PLACE)
        places = stage_table(removed.select(*PLACE).distinct(), "places")
        days = [r["day"] for r in places.select("day").distinct().collect()]
        if days:
            held = self.stored_silver().where(F.col("day").isin(days)).join(bounded_broadcast(places), PLACE, "left_semi")
            kept = stage_table(held.join(bounded_broadcast(removed), ["reading_id", *PLACE], "left_anti").select(*STORED.names), "kept")
            clear_partitions(spark, path, places.join(kept.select(*PLACE).distinct(), PLACE, "left_anti").select(*PLACE))
            replace_partitions(spark, kept, path, PLACE)
        remove_path(spark, staged_path(places))

    def apply_to_index(self, changes: DataFrame) -> None:
        entries = changes.where("sign > 0").select("reading_id", "ingested_at", "day", "hour", self.bucket().alias("bucket"), "batch")
        (entries.hint("rebalance", "bucket").sortWithinPartitions("bucket", "reading_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch").parquet(f"{self.root}/index"))

    def mart_changes(self, name: str, changes: DataFrame) -> DataFrame:
        return enrich(changes, self.registry) if MARTS[name].enriched else changes

    def apply_to_mart(self, name: str, changes: DataFrame, batch: int) -> None:
        spec, rows = MARTS[name], self.mart_changes(name, changes)
        for kind, df in (("state", spec.state_of(rows)), ("values", spec.values_of(rows))):
            (df.withColumn("batch", F.lit(batch).cast("long")).hint("rebalance", "part_day").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("part_day", "batch").parquet(f"{self.root}/{name}/{kind}"))

    def rebuild(self, name: str, batch: int) -> None:
        """A mart from all of silver, as one batch."""
        spec, rows = MARTS[name], self.mart_changes(name, self.stored_silver().withColumn("sign", F.lit(1)))
        for kind, df in (("state", spec.state_of(rows)), ("values", spec.values_of(rows))):
            replace_table(self.spark, df.withColumn("batch", F.lit(batch).cast("long")), f"{self.root}/{name}/{kind}", ["part_day", "batch"])

    def fingerprint(self) -> str | None:
        if self.registry is None:
            return None
        side = self.registry.enrich_side
        r = side.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*side.columns).cast("decimal(38,0)")).alias("h")).first()
        return f"{r['n']}:{r['h']}"

    def compact(self) -> None:
        """Add up the batches of marts and index for good, between runs. Each
        table is written aside and swapped in."""
        last = self.next_batch() - 1
        for name in self.marts:
            grain = MARTS[name].grain
            for kind, keys in (("state", [*grain, "part_day"]), ("values", [*grain, "part_day", "item", "value", "member"])):
                df = self._read(f"{name}/{kind}", self._state_schema(name, kind))
                sums = [c for c in df.columns if c not in (*keys, "batch")]
                one = df.groupBy(*keys).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sums]).where("n <> 0")
                replace_table(self.spark, one.withColumn("batch", F.lit(last).cast("long")), f"{self.root}/{name}/{kind}", ["part_day", "batch"])
        entries = self._read("index", INDEX)
        keep = entries.groupBy("bucket", "reading_id").agg(F.max_by(F.struct("ingested_at", "day", "hour", "batch"), "batch").alias("at"))
        replace_table(self.spark, keep.select("reading_id", "at.*", "bucket"), f"{self.root}/index", ["bucket", "batch"])

"""Device snapshots: nested JSON entries (one per sensor submission).

``read_snapshot`` is the scan; ``snapshot_from_supplier`` derives a snapshot
from the driver's ``supplier`` table so the registry path can be exercised
on data that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.schemas import SNAPSHOT_ENTRY
from sensorlake.sources.driver_tables import country_of, latitude_of, longitude_of
from sensorlake.sources.tables import stage_table

# FIXED VALUES of the derived snapshot (our own choice, mirrored by the oracle SQL).
SNAPSHOT_TYPES = ["SDS011", "BME280", "DHT22", "SPS30", "PMS5003"]
OLDER_TIMESTAMP = "2024-01-30T08:00:00"


def read_snapshot(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Scan landed snapshot files with the explicit nested schema.

    JSON lines (the default) split across tasks; ``multiline=True`` reads a
    single JSON array per file (one task per file).
    """
    return spark.read.schema(SNAPSHOT_ENTRY).option("multiLine", multiline).json(path)


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """Scan files that each hold one JSON array of entries, however long, each
    split over tasks (``read_snapshot`` takes a task per array).

    Files are read as text in pieces that end at a closing brace, so a scan
    split is a run of pieces. Whether a piece begins within a string, and how
    deep in brackets, depends on all before it: each split works both cases
    out, a row per split carries the state on, and every piece that closes an
    entry is then known. An entry is the pieces since the one before; those of
    an entry that two splits share meet by their key. Nested objects, escaped
    quotes and braces within strings are text of their entry; line breaks and
    spaces may stand anywhere between. An entry that doesn't fit the schema is
    a row of nulls, an empty array or file has no rows. Entries must be objects.
    What follows the last brace closes no entry, so an array that breaks off
    loses its last one.
    """
    text = spark.read.option("lineSep", "}").text(path)
    at = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("i"))
    # quotes that are escaped count for nothing; no piece ends between a backslash and its sign
    bare = F.regexp_replace("value", r"\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"')))

    def depth(piece, closes):
        outside = F.regexp_replace(piece, r'"[^"]*("|$)', "")
        up, down = (F.length(F.regexp_replace(outside, rf"[^{signs}]", "")) for signs in (r"\[{", r"\]}"))
        return up - down - F.when(closes, 1).otherwise(0)

    odd = quotes % 2 == 1
    at = at.select("file", "block", "i", "value", odd.cast("int").alias("odd"), depth(bare, ~odd).alias("from_out"),
                   depth(F.concat(F.lit('"'), bare), odd).alias("from_in"))
    w = Window.partitionBy("file", "block").orderBy("i")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("turned", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    other = F.col("turned") == 1
    at = at.withColumn("out", F.sum(F.when(other, F.col("from_in")).otherwise(F.col("from_out"))).over(w))
    at = at.withColumn("in", F.sum(F.when(other, F.col("from_out")).otherwise(F.col("from_in"))).over(w))
    at = stage_table(at.drop("from_out", "from_in"), "pieces")

    # a row per split: what its pieces add, then the state before it
    past = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    split = at.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.max("i").alias("last"), F.max_by("out", "i").alias("out"), F.max_by("in", "i").alias("in"))
    split = split.withColumn("last", F.when(F.col("block") == F.max("block").over(Window.partitionBy("file")), F.col("last")).otherwise(-1))
    split = split.withColumn("starts_in", F.coalesce(F.sum("odd").over(past), F.lit(0)) % 2)
    grown = F.when(F.col("starts_in") == 1, F.col("in")).otherwise(F.col("out"))
    split = split.withColumn("deep", F.coalesce(F.sum(grown).over(past), F.lit(0))).select("file", "block", "starts_in", "deep", "last")

    at = at.join(split, ["file", "block"])
    inside = (F.col("turned") + F.col("starts_in") + F.col("odd")) % 2 == 1
    level = F.col("deep") + F.when(F.col("starts_in") == 1, F.col("in")).otherwise(F.col("out"))
    at = at.select("file", "block", "i", "value", (~inside & (level == 1) & (F.col("i") != F.col("last"))).alias("closes"))
    # an entry goes by the place of the close before it
    mark = F.when(F.col("closes"), F.struct("block", "i"))
    ends = at.groupBy("file", "block").agg(F.max(mark).alias("end"))
    ends = ends.select("file", "block", F.max("end").over(past).alias("earlier"))
    at = at.withColumn("mine", F.max(mark).over(before)).join(ends, ["file", "block"])
    pieces = at.groupBy("file", F.coalesce("mine", "earlier").alias("entry")).agg(
        F.sort_array(F.collect_list(F.struct("block", "i", "value"))).alias("parts"), F.bool_or("closes").alias("whole"))
    entry = F.concat(F.array_join(F.transform("parts", lambda x: x["value"]), "}"), F.lit("}"))
    entry = F.regexp_replace(entry, r"^[\s,\[\uFEFF]*", "")
    return pieces.where("whole").select(F.from_json(entry, SNAPSHOT_ENTRY).alias("e")).select("e.*")


def by_country(snapshot: DataFrame, country: str = "DE") -> DataFrame:
    return snapshot.where(F.col("location.country") == country)


def snapshot_from_supplier(supplier: DataFrame) -> DataFrame:
    """Entries per supplier: the newest submission, an older one (% 7 = 0),
    and a same-time duplicate with a higher top-level id (% 23 = 11); dirt:
    NULL sensor id, missing type, out-of-range or unparseable coordinates,
    missing country, empty / duplicated / non-numeric measurements."""
    sid = F.col("s_suppkey")
    copies = F.sequence(F.lit(0), F.when(sid % 23 == 11, 2).when(sid % 7 == 0, 1).otherwise(0))
    s = supplier.select("s_suppkey", "s_nationkey", "s_acctbal", F.explode(copies).alias("c"))
    s = s.where((F.col("c") == 0) | ((F.col("c") == 1) & (sid % 7 == 0)) | ((F.col("c") == 2) & (sid % 23 == 11)))
    c = F.col("c")
    ts = F.when(c == 1, F.lit(OLDER_TIMESTAMP)).otherwise(
        F.concat(F.lit("2024-01-31T"), F.lpad((sid % 24).cast("string"), 2, "0"), F.lit(":00:00")))
    type_name = (F.when(c == 2, F.lit("SEN5x"))
                 .when(sid % 37 == 4, F.lit(None).cast("string"))
                 .otherwise(F.element_at(F.array(*[F.lit(t) for t in SNAPSHOT_TYPES]), (sid % 5).cast("int") + 1)))
    lat = (F.when((sid % 29 == 5) & (c == 0), F.lit("999"))
           .when(sid % 31 == 6, F.lit("not_a_number"))
           .otherwise((latitude_of(sid) + c).cast("string")))
    lon = F.when(sid % 43 == 7, F.lit("999")).otherwise(longitude_of(sid).cast("string"))
    country = F.when(sid % 47 == 8, F.lit(None).cast("string")).otherwise(country_of(F.col("s_nationkey")))

    def entry(name, value, keep):
        return F.struct(F.lit(name).alias("value_type"), value.alias("value"), keep.alias("keep"))

    t = F.lit(True)
    items = F.array(
        entry("P1", F.col("s_acctbal").cast("decimal(12,2)").cast("string"), t),
        entry("P2", F.when(sid % 13 == 0, F.lit("n/a")).otherwise((sid % 50).cast("string")), t),
        entry("temperature", (sid % 35).cast("string"), t),
        entry("P1", F.lit("42.5"), sid % 17 == 10),
        entry("", F.lit("5"), sid % 11 == 1),
        entry("humidity", F.lit(None).cast("string"), sid % 11 == 1),
    )
    kept = F.transform(F.filter(items, lambda e: e["keep"]),
                       lambda e: F.struct(e["value_type"].alias("value_type"), e["value"].alias("value")))
    values = F.when(sid % 19 == 9, F.filter(kept, lambda e: F.lit(False))).otherwise(kept)
    return s.select(
        (sid * 10 + c).cast("bigint").alias("id"),
        ts.alias("timestamp"),
        F.struct(F.when(sid % 41 != 3, sid.cast("bigint")).alias("id"),
                 F.struct(type_name.alias("name")).alias("sensor_type")).alias("sensor"),
        F.struct(lat.alias("latitude"), lon.alias("longitude"), country.alias("country")).alias("location"),
        values.alias("sensordatavalues"),
    )


def land_arrays(snapshot: DataFrame, path: str, entries: int = 1_000_000) -> str:
    """Write entries as JSON arrays, one to a file and some ``entries`` in each,
    a line an entry, and return the path. Ids must differ."""
    rows = snapshot.select("id", F.to_json(F.struct("*")).alias("json"))
    files = max(1, -(-rows.count() // entries))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(files)).cast("int"))
    first = rows.groupBy("part").agg(F.min("id").alias("first"))
    rows = rows.join(F.broadcast(first), "part")
    opens = F.when(F.col("id") == F.col("first"), F.lit("[")).otherwise(F.lit(","))
    lines = rows.select("part", F.lit(0).alias("last"), "id", F.concat(opens, "json").alias("value"))
    lines = lines.unionByName(first.select("part", F.lit(1).alias("last"), F.col("first").alias("id"), F.lit("]").alias("value")))
    lines = lines.repartition(files, "part").sortWithinPartitions("part", "last", "id")
    lines.select("part", "value").write.mode("overwrite").partitionBy("part").text(path)
    return path


def land_snapshot(snapshot: DataFrame, path: str) -> str:
    """Write entries as JSON lines (what a fetch job lands) and return the path."""
    snapshot.write.mode("overwrite").json(path)
    return path

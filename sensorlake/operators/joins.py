"""Registry joins with a checked broadcast.

Dimension tables are broadcast only after their row count and payload bytes
have been measured against bounds; above them the join is left to
Catalyst/AQE (sort-merge or shuffled hash), so a registry that outgrows
memory never breaks the job.

A ``Registry`` holds one refresh's dimensions and checks each broadcast side
once, however many marts and alert queries then join against it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A registry row is a few ids and short strings (< 100 bytes); two million
# rows stay well under a 200 MB broadcast. Both bounds must hold.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20


# Bytes of fixed-width values (decimals up to 18 digits fit a long).
_WIDTH = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
          T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8}


def _fixed_width(t: T.DataType) -> int:
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    return _WIDTH.get(type(t), 8)


def row_bytes(df: DataFrame) -> Column:
    """Payload bytes of a row: string/binary lengths plus fixed-width sizes
    (complex values by the length of their JSON text)."""
    sizes = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            sizes.append(F.lit(_fixed_width(f.dataType)))
    total = F.lit(0)
    for size in sizes:
        total = total + size
    return total.cast("bigint")


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and
    ``max_bytes`` bytes of payload, else ``df`` (Catalyst / AQE then choose a
    shuffled join).

    One job on the side measures both: each task sends one partial row.
    """
    m = df.agg(F.count(F.lit(1)).alias("n"),
                                   F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if m["n"] <= max_rows and m["b"] <= max_bytes else df


def registry(dim_sensors: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """dim_sensors LEFT JOIN dim_customers on customer_id, joined once.

    Both sides are dimensions; the caller checks the joined result's size
    before broadcasting it, and Catalyst picks the strategy for this join.
    """
    ds = dim_sensors.select("sensor_id", F.col("country").alias("ds_country"), "customer_id")
    dc = dim_customers.select("customer_id", "customer_name", F.col("region").alias("dc_region"))
    return ds.join(dc, "customer_id", "left")


def lookup_registry(dim_sensors: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """sensors INNER customers: the per-sensor customer lookup, set-wise."""
    return (dim_sensors.select("sensor_id", F.col("customer_id").alias("_cid"))
            .join(dim_customers.select(F.col("customer_id").alias("_cid"), "customer_name",
                                       F.col("region").alias("_cregion")), "_cid", "inner")
            .select("sensor_id", F.col("_cid").alias("customer_id"), "customer_name",
                    F.col("_cregion").alias("customer_region")))


class Registry:
    """Sensors and customers of one refresh, with size-checked join sides.

    Each side (enrichment, customer lookup, known ids) is measured at most
    once, when first used; it is broadcast only within the row and byte bounds.
    """

    def __init__(self, dim_sensors: DataFrame, dim_customers: DataFrame | None,
                 max_rows: int = MAX_BROADCAST_ROWS):
        self.dim_sensors = dim_sensors
        self.dim_customers = dim_customers
        self.max_rows = max_rows

    @cached_property
    def enrich_side(self) -> DataFrame:
        return bounded_broadcast(registry(self.dim_sensors, self.dim_customers), self.max_rows)

    @cached_property
    def lookup_side(self) -> DataFrame:
        return bounded_broadcast(lookup_registry(self.dim_sensors, self.dim_customers), self.max_rows)

    @cached_property
    def known_ids(self) -> DataFrame:
        return bounded_broadcast(self.dim_sensors.select("sensor_id"), self.max_rows)


def as_registry(dim_sensors, dim_customers=None, max_rows: int = MAX_BROADCAST_ROWS) -> Registry:
    """Accept either a ready ``Registry`` or the two dimension frames."""
    if isinstance(dim_sensors, Registry):
        return dim_sensors
    return Registry(dim_sensors, dim_customers, max_rows)


def enrich(facts: DataFrame, dim_sensors, dim_customers: DataFrame | None = None,
           max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Facts LEFT JOIN sensors LEFT JOIN customers, with 'Unknown' fallbacks.

    Adds ``country`` = registry country else the reading's, ``region`` and
    ``customer_name`` from the customer row (not the sensor row).
    ``dim_sensors`` may be a ``Registry`` (then ``dim_customers`` is unused).
    """
    reg = as_registry(dim_sensors, dim_customers, max_rows).enrich_side
    joined = facts.join(reg, "sensor_id", "left")
    return (joined
            .withColumn("country", F.coalesce(F.col("ds_country"), F.col("country")))
            .withColumn("region", F.coalesce(F.col("dc_region"), F.lit("Unknown")))
            .withColumn("customer_name", F.coalesce(F.col("customer_name"), F.lit("Unknown")))
            .drop("ds_country", "dc_region"))


def customer_lookup(facts: DataFrame, dim_sensors, dim_customers: DataFrame | None = None,
                    max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Set-wise form of the per-sensor customer lookup (sensors INNER customers).

    Adds ``customer_id``, ``customer_name``, ``customer_region`` (NULL when the
    sensor has no customer row), keeping every fact row.
    """
    return facts.join(as_registry(dim_sensors, dim_customers, max_rows).lookup_side, "sensor_id", "left")

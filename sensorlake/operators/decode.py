"""Message decode (bytes -> bronze row) with a dead-letter side, and re-keying.

Each payload is parsed into a Variant; ``values`` alone is also cut out of the
text, as a Variant would put its keys in another order. Missing fields and
JSON nulls take the bronze defaults; a payload that is not a JSON object, or a
field that is present but cannot be cast, goes to the dead-letter frame with a
reason instead of failing the job.

Alerts are taken from the message, not from bronze: a default would raise them
for a sensor 0 that sent nothing, and a reading that bronze refuses for its
place still has a pressure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.scalar import hour_parts, parse_values

# FIXED VALUES: bronze defaults for a missing field (reading_id has none).
DEFAULTS = {"sensor_id": 0, "sensor_type": "", "ingested_at": "", "latitude": 0.0,
            "longitude": 0.0, "country": "", "values": "{}"}
_NUMERIC = {"sensor_id": "bigint", "latitude": "double", "longitude": "double"}
_TEXT = ["sensor_type", "ingested_at", "country"]
# What is taken from the Variant in one go, as each would be by itself.
_PARTS = "struct<reading_id:string,sensor_type:string,ingested_at:string,country:string,values:variant>"


def _absent(v: Column, key: str) -> Column:
    raw = F.try_variant_get(v, f"$.{key}", "variant")
    return raw.isNull() | F.is_variant_null(raw)


def _parsed(messages: DataFrame) -> DataFrame:
    """Payload text and its Variant, computed once.

    ``spark_partition_id()`` is nondeterministic, so the optimizer keeps the
    dead-letter filter above this projection instead of pushing it below and
    parsing every payload a second time inside the filter.
    """
    text = F.col("value").cast("string")
    return messages.select("*", text.alias("_text")).select(
        "*", F.try_parse_json("_text").alias("_v"), F.spark_partition_id().alias("_part"))


def _is_object() -> Column:
    """Of text that is JSON: whether it is an object, by its first sign."""
    return F.col("_text").rlike(r"^\s*\{")


def _with_fields(p: DataFrame) -> DataFrame:
    v = F.col("_v")
    # numbers are cast once, and only where there is none is it asked why; the
    # ``_part`` of this projection keeps a filter on the reason above the casts
    casts = {f"_cast_{key}": F.try_variant_get(v, f"$.{key}", type_name) for key, type_name in _NUMERIC.items()}
    p = p.withColumns(casts | {"_f": F.try_variant_get(v, "$", _PARTS), "_part": F.spark_partition_id()})
    cols = {"reading_id": F.col("_f.reading_id")}
    bad = []
    for key, type_name in _NUMERIC.items():
        cast = F.col(f"_cast_{key}")
        cols[key] = F.when(cast.isNotNull(), cast).when(_absent(v, key), F.lit(DEFAULTS[key]).cast(type_name))
        bad.append(F.when(cast.isNull() & ~_absent(v, key), F.lit(f"uncastable_{key}")))
    for key in _TEXT:
        cols[key] = F.coalesce(F.col(f"_f.{key}"), F.lit(DEFAULTS[key]))
    sub = F.col("_f.values")
    # a text is kept as JSON, with its quotes; only where the message's text
    # allows for one (or escapes its keys) is the kind of ``values`` looked at
    perhaps = F.col("_text").rlike(r'"values"\s*:\s*"|\\')
    raw = F.when(perhaps & (F.schema_of_variant(sub) == "STRING"), F.to_json(sub)).otherwise(F.get_json_object("_text", "$.values"))
    cols["values"] = F.coalesce(raw, F.lit(DEFAULTS["values"]))
    # the text parsed again; without an escape in it, that is what ``sub`` holds
    cols["_values"] = F.when(F.contains(F.col("_text"), F.lit("\\")), parse_values(cols["values"])).otherwise(sub)
    reason = (F.when(v.isNull(), F.lit("invalid_json"))
              .when(~_is_object(), F.lit("not_a_json_object"))
              .otherwise(F.coalesce(*bad)))
    return p.select("*", *[c.alias(k) for k, c in cols.items()], reason.alias("_reason")).drop("_f", *casts)


BRONZE_FIELDS = ["reading_id", "sensor_id", "sensor_type", "ingested_at", "latitude",
                 "longitude", "country", "values"]


def decoded(messages: DataFrame) -> DataFrame:
    """Every message once, with its fields and ``_reason``: what ``split`` makes
    bronze and dead letters of. Persist or write it, and both come from one
    decode."""
    return _with_fields(_parsed(messages)).drop("_v", "_values")


def decode(messages: DataFrame, hour_from: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(bronze, dead_letter) from a ``(key, value, timestamp)`` frame.

    Partition columns come from ``hour_from`` (the arrival clock by default;
    pass a parsed event-time column to partition by reading time instead).
    """
    return split(_with_fields(_parsed(messages)), hour_from)


def parsed_bronze(messages: DataFrame) -> DataFrame:
    """Bronze rows for silver alone: ``values`` as a Variant, which is neither
    written as text nor parsed again, and no partition columns."""
    f = _with_fields(_parsed(messages)).where(F.col("_reason").isNull() & (F.col("_part") >= 0))
    return f.withColumn("values", F.col("_values")).select(*BRONZE_FIELDS)


def split(f: DataFrame, hour_from: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(bronze, dead_letter) of a ``decoded`` frame."""
    # ``_part >= 0`` is always true; referencing the column keeps the barrier
    # projection (see ``_parsed``) from being pruned away.
    kept = F.col("_part") >= 0
    bronze = (f.where(F.col("_reason").isNull() & kept)
              .select(*BRONZE_FIELDS, *hour_parts(F.col(hour_from)), F.col(hour_from).alias("_arrival")))
    dead = f.where(F.col("_reason").isNotNull() & kept).select(
        F.col("key").cast("string").alias("key"), F.col("_text").alias("raw_value"),
        F.col("timestamp"), F.col("_reason").alias("reason"))
    return bronze, dead


def alert_readings(messages: DataFrame) -> DataFrame:
    """What alerts need of every message that is an object and has a sensor id:
    sensor_id, reading_id, pressure, the place as numbers (NULL if they are
    none) and as text, country, sensor_type, the message's text and time."""
    p = _parsed(messages).where(F.col("_v").isNotNull() & _is_object() & (F.col("_part") >= 0))
    v = F.col("_v")
    get = lambda key, kind: F.try_variant_get(v, f"$.{key}", kind)
    return p.select(
        get("sensor_id", "bigint").alias("sensor_id"), get("reading_id", "string").alias("reading_id"),
        get("values.pressure", "double").alias("pressure"),
        get("latitude", "double").alias("latitude"), get("longitude", "double").alias("longitude"),
        get("latitude", "string").alias("latitude_text"), get("longitude", "string").alias("longitude_text"),
        get("country", "string").alias("country"), get("sensor_type", "string").alias("sensor_type"),
        F.col("_text").alias("message_text"), "timestamp").where(F.col("sensor_id").isNotNull())


def rekey(messages: DataFrame) -> DataFrame:
    """Republish shape: value verbatim, key = sensor id text, '' when missing or
    the number 0 (the text "0" is kept).

    Payloads that are not a JSON object are not forwarded.
    """
    p = _parsed(messages).where(F.col("_v").isNotNull() & _is_object())
    raw = F.try_variant_get("_v", "$.sensor_id", "variant")
    sid = F.try_variant_get("_v", "$.sensor_id", "string")
    zero = (F.schema_of_variant(raw) != "STRING") & (F.try_variant_get("_v", "$.sensor_id", "double") == 0)
    key = F.when(sid.isNull() | F.coalesce(zero, F.lit(False)), F.lit("")).otherwise(sid)
    return p.select(key.cast("binary").alias("key"), F.col("value"))

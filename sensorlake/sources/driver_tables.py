"""Readings, messages and the device registry derived from the driver tables.

The driver tables carry no sensors, so this adapter maps them (one scan of
``events``, no driver-side data):

- reading_id = event_id as text, sensor_id = user_id, sensor_type = event_type
- ingested_at = the event time as ISO text with a ``+00:00`` offset
- values = a JSON object whose keys depend on the event type
- every 10th event (event_id % 10 = 3) is delivered twice, one minute apart
- dirt: NULL id (event_id % 97 = 0), unparseable time (% 89 = 1), junk
  type 'test' (% 83 = 2)

The registry: ``supplier`` rows are the registered sensors, ``nation`` rows
the customers, ``region`` names their regions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.scalar import hour_parts

# FIXED VALUES of this adapter (our own choice, mirrored by the oracle SQL):
# country code of nation key 0..24, in key order.
NATION_COUNTRY = [
    "DE", "FR", "US", "CN", "BR", "IT", "JP", "IN", "GB", "CA", "ES", "AU", "PL",
    "MX", "NL", "KR", "SE", "ZA", "CH", "AR", "AT", "NG", "NO", "ID", "CZ",
]
PARTICLE_EVENTS = ["view", "click"]
CLIMATE_EVENTS = ["purchase", "signup"]
BAD_TIME_TEXT = "garbage"
BAD_DATE_TEXT = "2024-13-45T00:00:00+00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(col: Column) -> Column:
    """Two-decimal text of a double, the same in every engine."""
    return col.cast("decimal(12,2)").cast("string")


def country_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in NATION_COUNTRY]), (key % 25).cast("int") + 1)


def latitude_of(sensor_id: Column) -> Column:
    return ((sensor_id * 37) % 170 - 85).cast("double")


def longitude_of(sensor_id: Column) -> Column:
    return ((sensor_id * 53) % 360 - 180).cast("double")


def _values_text(event_id: Column, event_type: Column, value: Column, k: Column) -> Column:
    pressure = (F.lit(100000) + k * 500).cast("string")
    particle = F.concat(F.lit('{"P1": '), _dec(value), F.lit(', "P2": '), k.cast("string"), F.lit("}"))
    climate = F.concat(F.lit('{"temperature": '), _dec(value - 20), F.lit(', "humidity": '),
                       k.cast("string"), F.lit(', "pressure": '), pressure, F.lit("}"))
    junk = F.concat(F.lit('{"P1": "n/a", "pressure": "'),
                    F.when(k % 7 == 0, F.lit("NaN")).otherwise(pressure), F.lit('"}'))
    return (F.when(event_id % 307 == 11, F.lit('{"P1": "NaN", "P2": 3}'))
            .when(event_id % 311 == 12, F.lit('{"P1": "Infinity", "temperature": "-Infinity", "humidity": 5}'))
            .when(event_id % 313 == 13, F.lit('{"P1": "2500000000000.5", "P2": "4e24", "temperature": "1e300", "pressure": "NaN"}'))
            .when(event_type.isin(*PARTICLE_EVENTS), particle)
            .when(event_type.isin(*CLIMATE_EVENTS), climate)
            .otherwise(junk))


def _deliveries(events: DataFrame) -> DataFrame:
    """One row per delivery: redelivered events appear twice (one scan)."""
    copies = F.sequence(F.lit(0), F.when(F.col("event_id") % 10 == 3, 1).otherwise(0))
    return (events
            .select("event_id", "ts", "user_id", "event_type", "value",
                    F.get_json_object("props", "$.k").cast("int").alias("k"),
                    F.explode(copies).alias("copy"))
            .withColumn("arrival", F.col("ts") + F.make_dt_interval(mins=F.col("copy"))))


def _reading_columns(d: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    k = F.col("k")
    good_time = F.concat(F.date_format("arrival", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    bad_time = F.when(eid % 2 == 0, F.lit(BAD_TIME_TEXT)).otherwise(F.lit(BAD_DATE_TEXT))
    return d.select(
        F.when(eid % 97 != 0, eid.cast("string")).alias("reading_id"),
        F.col("user_id").cast("bigint").alias("sensor_id"),
        F.when(eid % 83 == 2, F.lit("test")).otherwise(F.col("event_type")).alias("sensor_type"),
        F.when(eid % 89 == 1, bad_time).otherwise(good_time).alias("ingested_at"),
        latitude_of(F.col("user_id")).alias("latitude"),
        longitude_of(F.col("user_id")).alias("longitude"),
        country_of(F.col("user_id")).alias("country"),
        _values_text(eid, F.col("event_type"), F.col("value"), k).alias("values"),
        F.col("arrival"),
        eid.alias("event_id"),
        F.col("copy"),
    )


def readings(events: DataFrame) -> DataFrame:
    """Bronze-shaped readings with ``arrival`` (timestamp_ntz) and event_id."""
    return _reading_columns(_deliveries(events))


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Landed bronze: reading columns plus year/month/day/hour of arrival."""
    r = readings(events)
    return r.select("reading_id", "sensor_id", "sensor_type", "ingested_at", "latitude",
                    "longitude", "country", "values", *hour_parts(F.col("arrival")))


def _iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def two_landings(events: DataFrame, cut: str) -> tuple[DataFrame, DataFrame]:
    """Bronze as two runs of the pipeline find it, with what an incremental
    run must not trip over. By event id:

    - % 211 = 5: a clock in 2031; % 61 = 8: one that is 3 hours ahead
    - % 30 = 1: lands with the second run, in hours that the first has read
    - % 41 = 7: a copy dated 36 hours earlier (another day) lands second
    - % 43 = 9: a copy of the same instant with other values lands second
    - % 47 = 10: a first delivery 15 days old, landing second in a late hour
    """
    r = readings(events)
    eid, text = F.col("event_id"), F.col("ingested_at")
    good = eid % 89 != 1
    r = r.withColumn("ingested_at", F.when((eid % 211 == 5) & good, F.lit("2031-06-01T00:00:00.000000+00:00"))
                     .when((eid % 61 == 8) & good, _iso(F.col("arrival") + F.make_dt_interval(hours=F.lit(3))))
                     .when((eid % 47 == 10) & good, _iso(F.col("arrival") - F.make_dt_interval(days=F.lit(15))))
                     .otherwise(text))
    key = F.date_format("arrival", "yyyyMMddHH")
    second = (key >= F.lit(cut)) | (eid % 30 == 1) | (eid % 47 == 10)
    once = r.where((F.col("copy") == 0) & good)
    earlier = once.where(eid % 41 == 7).withColumn("ingested_at", _iso(F.col("arrival") - F.make_dt_interval(hours=F.lit(36))))
    equal = (once.where((eid % 43 == 9) & (eid % 211 != 5) & (eid % 61 != 8) & (eid % 47 != 10))
             .withColumn("values", F.lit('{"P1": 1.5, "P2": 1}')))

    def landed(df: DataFrame) -> DataFrame:
        return df.select("reading_id", "sensor_id", "sensor_type", "ingested_at", "latitude", "longitude",
                         "country", "values", *hour_parts(F.col("arrival")))
    return landed(r.where(~second)), landed(r.where(second)).unionByName(landed(earlier)).unionByName(landed(equal))


def late_messages(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two waves of messages whose clocks are not in step with their arrival
    (by event id: % 211 = 5 in 2031; % 47 = 10 first delivered 15 days late, in
    the second wave; % 41 = 7 with a copy dated 36 hours earlier, in the second
    wave; redeliveries there too, but for % 20 = 3, whose later copy comes first)."""
    r = readings(events)
    eid = F.col("event_id")
    good = eid % 89 != 1
    r = r.withColumn("ingested_at", F.when((eid % 211 == 5) & good, F.lit("2031-06-01T00:00:00.000000+00:00"))
                     .when((eid % 47 == 10) & good, _iso(F.col("arrival") - F.make_dt_interval(days=F.lit(15))))
                     .otherwise(F.col("ingested_at")))
    second = (eid % 47 == 10) | F.when(eid % 20 == 3, F.col("copy") == 0).otherwise(F.col("copy") == 1)
    earlier = r.where((F.col("copy") == 0) & good & (eid % 41 == 7)).withColumn(
        "ingested_at", _iso(F.col("arrival") - F.make_dt_interval(hours=F.lit(36))))
    return _messages(r.where(~second)), _messages(r.where(second).unionByName(earlier))


def messages_from_events(events: DataFrame, copy: int | None = None) -> DataFrame:
    """Kafka-shaped frame (key, value, timestamp) of JSON reading messages.

    Extra dirt on the wire: missing reading_id, sensor_id as numeric text
    (% 71 = 4), uncastable sensor_id (% 59 = 9), missing sensor_id (% 67 = 8),
    JSON null country (% 61 = 5), missing values (% 53 = 6), latitude that is
    no number (% 73 = 10), non-JSON payload (% 101 = 7), JSON that is no object
    (% 103 = 8), values given as text (% 107 = 9), sensor id "0" (% 109 = 10).
    """
    r = readings(events)
    return _messages(r if copy is None else r.where(F.col("copy") == copy))


def _messages(r: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    sid = F.col("sensor_id").cast("string")
    parts = [
        F.when(F.col("reading_id").isNotNull(), F.concat(F.lit('"reading_id": '), q(F.col("reading_id")), F.lit(", "))).otherwise(F.lit("")),
        F.when(eid % 67 == 8, F.lit(""))
         .when(eid % 59 == 9, F.lit('"sensor_id": "abc", '))
         .when(eid % 109 == 10, F.lit('"sensor_id": "0", '))
         .when(eid % 71 == 4, F.concat(F.lit('"sensor_id": '), q(sid), F.lit(", ")))
         .otherwise(F.concat(F.lit('"sensor_id": '), sid, F.lit(", "))),
        F.concat(F.lit('"sensor_type": '), q(F.col("sensor_type")), F.lit(", ")),
        F.concat(F.lit('"ingested_at": '), q(F.col("ingested_at")), F.lit(", ")),
        F.when(eid % 73 == 10, F.lit('"latitude": "unknown", '))
         .otherwise(F.concat(F.lit('"latitude": '), F.col("latitude").cast("string"), F.lit(", "))),
        F.concat(F.lit('"longitude": '), F.col("longitude").cast("string"), F.lit(", ")),
        F.when(eid % 61 == 5, F.lit('"country": null'))
         .otherwise(F.concat(F.lit('"country": '), q(F.col("country")))),
        F.when(eid % 53 == 6, F.lit("")).when(eid % 107 == 9, F.lit(', "values": "abc"'))
         .otherwise(F.concat(F.lit(', "values": '), F.col("values"))),
    ]
    body = F.concat(F.lit("{"), *parts, F.lit("}"))
    value = (F.when(eid % 101 == 7, F.concat(F.lit("corrupt:"), eid.cast("string")))
             .when(eid % 103 == 8, F.when(eid % 2 == 0, F.lit("[1]")).otherwise(F.lit("42"))).otherwise(body))
    key = F.when(eid % 67 == 8, F.lit("")).otherwise(sid)
    return r.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"),
                    F.col("arrival").cast("timestamp").alias("timestamp"),
                    eid.alias("event_id"))


def dim_customers(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("int").alias("customer_id"),
                    F.col("n_name").alias("customer_name"),
                    F.col("r_name").alias("region")))


def sensor_keys(supplier: DataFrame) -> DataFrame:
    """The registry columns of ``dim_sensors`` (sensor_id, country,
    customer_id), read from ``supplier`` alone. Joins that need only these
    use this frame: the customer-region join that ``dim_sensors`` adds for
    its ``region`` column cannot be dropped by the optimizer, and would be
    one more broadcast stage in every registry side."""
    return supplier.select(F.col("s_suppkey").cast("bigint").alias("sensor_id"),
                           country_of(F.col("s_nationkey")).alias("country"),
                           F.col("s_nationkey").cast("int").alias("customer_id"))


def dim_sensors(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Registered sensors: one per supplier, customer = the supplier's nation."""
    customers = dim_customers(nation, region)
    s = supplier.select("s_suppkey", "s_nationkey")
    return (s.join(customers, s.s_nationkey == customers.customer_id, "left")
            .select(F.col("s_suppkey").cast("bigint").alias("sensor_id"),
                    F.when(F.col("s_suppkey") % 2 == 0, F.lit("SDS011")).otherwise(F.lit("BME280")).alias("sensor_type"),
                    latitude_of(F.col("s_suppkey")).alias("latitude"),
                    longitude_of(F.col("s_suppkey")).alias("longitude"),
                    country_of(F.col("s_nationkey")).alias("country"),
                    F.col("region"),
                    F.col("s_nationkey").cast("int").alias("customer_id")))


def dims_from_customer_table(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """A second, full-coverage registry (one sensor per ``customer`` row)."""
    customers = dim_customers(nation, region)
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return (c.join(customers, c.c_nationkey == customers.customer_id, "left")
            .select(F.col("c_custkey").cast("bigint").alias("sensor_id"),
                    F.when(F.col("c_mktsegment") == "BUILDING", F.lit("SPS30")).otherwise(F.lit("DHT22")).alias("sensor_type"),
                    latitude_of(F.col("c_custkey")).alias("latitude"),
                    longitude_of(F.col("c_custkey")).alias("longitude"),
                    country_of(F.col("c_nationkey")).alias("country"),
                    F.col("region"),
                    F.col("c_nationkey").cast("int").alias("customer_id")))

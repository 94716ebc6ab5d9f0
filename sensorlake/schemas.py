"""Table schemas of the pipeline (bronze, silver, rejected, dims, alerts, snapshot)."""

from pyspark.sql import types as T

PARTITION_COLUMNS = ["year", "month", "day", "hour"]

# What the ingest writes: schema-on-write, ``values`` kept as JSON text and
# ``ingested_at`` as the producer's text.
BRONZE_DATA = T.StructType([
    T.StructField("reading_id", T.StringType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("values", T.StringType()),
])

# Read back with explicit string partition columns, so "06" stays "06".
BRONZE = T.StructType(BRONZE_DATA.fields + [
    T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS
])

SILVER = T.StructType([
    T.StructField("reading_id", T.StringType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("pm25", T.DoubleType()),
    T.StructField("pm10", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("pressure_at_sealevel", T.DoubleType()),
])

DIM_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("region", T.StringType()),
])

DIM_SENSORS = T.StructType([
    T.StructField("sensor_id", T.LongType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("customer_id", T.IntegerType()),
])

ALERT_LOG = T.StructType([
    T.StructField("alert_id", T.LongType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("reading_id", T.StringType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# The frame a message source hands to decode (Kafka's shape).
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

SNAPSHOT_ENTRY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("sensor", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("sensor_type", T.StructType([T.StructField("name", T.StringType())])),
    ])),
    T.StructField("location", T.StructType([
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField("country", T.StringType()),
    ])),
    T.StructField("sensordatavalues", T.ArrayType(T.StructType([
        T.StructField("value_type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

VALUE_RANGE = T.StructType([
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])

PROFILE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("value_ranges", T.MapType(T.StringType(), VALUE_RANGE)),
])

PARTITION_STATUS = T.StructType(
    [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS] + [
        T.StructField("has_data", T.BooleanType()),
        T.StructField("closed_at", T.TimestampType()),
    ]
)

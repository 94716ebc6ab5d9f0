"""Streaming message sources.

Every query consumes a ``(key, value, timestamp)`` frame. On a cluster that
frame comes from Kafka (the connector jar must be on the classpath); in
tests it comes from landed files of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.schemas import MESSAGE


def kafka_messages(spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source: offsets live in the query checkpoint (not auto-commit).

    The bronze query starts at ``earliest``; the alert query uses its own
    checkpoint and ``latest``, like an independent consumer group.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select("key", "value", "timestamp")


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed message files (Parquet with the Kafka frame's schema)."""
    r = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


# A scan is split by row groups. Messages are short to read and long to decode,
# so a file has a group for each 16 MB and not, as by default, for 128.
ROW_GROUP_BYTES = 16 << 20


def land_messages(messages: DataFrame, path: str) -> None:
    """Append a wave of messages as files (what a topic archiver would land)."""
    messages.select("key", "value", "timestamp").write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)

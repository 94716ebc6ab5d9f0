"""Inputs shared by the catalog's queries.

Every query makes its own: tables are listed, plans are built and broadcast
sides are measured anew each time, within one query once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sensorlake.operators.joins import Registry
from sensorlake.operators.silver import build_silver
from sensorlake.session import use_utc
from sensorlake.sources import driver_tables as dt

class Inputs:
    """Driver tables and the pipeline layers derived from them (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        use_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return dt.load(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def bronze(self) -> DataFrame:
        return dt.bronze_from_events(self.events)

    @cached_property
    def messages(self) -> DataFrame:
        return dt.messages_from_events(self.events)

    @cached_property
    def silver(self) -> DataFrame:
        return build_silver(self.bronze)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dt.dim_customers(self.table("nation"), self.table("region"))

    @cached_property
    def dim_sensors(self) -> DataFrame:
        return dt.dim_sensors(self.table("supplier"), self.table("nation"), self.table("region"))

    @cached_property
    def registry(self) -> Registry:
        """Sensors and customers with each broadcast side checked once; the
        sensor side is ``dim_sensors``' registry columns only."""
        return Registry(dt.sensor_keys(self.table("supplier")), self.dim_customers)

    # message path: decoded bronze (with arrival time) and dead letters

    @cached_property
    def decoded(self):
        from sensorlake.operators.decode import decode
        return decode(self.messages)

    @cached_property
    def alert_readings(self) -> DataFrame:
        from sensorlake.operators.decode import alert_readings
        return alert_readings(self.messages)

    @property
    def decoded_bronze(self) -> DataFrame:
        return self.decoded[0]

    @property
    def dead_letter(self) -> DataFrame:
        return self.decoded[1]

    # written by each query for itself

    @cached_property
    def snapshot(self) -> DataFrame:
        """Snapshot derived from ``supplier``, landed as JSON lines and scanned back."""
        from sensorlake.session import scratch_path
        from sensorlake.sources.snapshot import land_snapshot, read_snapshot, snapshot_from_supplier
        path = land_snapshot(snapshot_from_supplier(self.table("supplier")), scratch_path(self.spark, "snapshot"))
        return read_snapshot(self.spark, path)

    @cached_property
    def landed_path(self) -> str:
        from sensorlake.operators.partitions import write_bronze
        from sensorlake.session import scratch_path
        return write_bronze(self.bronze, scratch_path(self.spark, "bronze"))

    @property
    def landed_bronze(self) -> DataFrame:
        """Bronze written in the Hive hour layout and scanned back."""
        from sensorlake.operators.partitions import read_bronze
        return read_bronze(self.spark, self.landed_path)

    @property
    def landed_hours(self) -> DataFrame:
        """The hours of landed bronze, from its file listing."""
        from sensorlake.operators.partitions import listed_hours
        return listed_hours(self.spark, self.landed_path)

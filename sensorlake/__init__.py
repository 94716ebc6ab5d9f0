"""Sensor-reading analytics on Spark: bronze -> silver -> gold, alerts, registry.

Every operator is a function from DataFrames to a DataFrame, written with
``pyspark.sql.functions`` so Catalyst can push filters, prune columns and
keep the work inside whole-stage codegen.
"""

from sensorlake import schemas
from sensorlake.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path", "schemas"]

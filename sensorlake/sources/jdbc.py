"""JDBC registry adapter: explicit column lists, partitioned reads, bulk writes.

Only Spark's own JDBC data source is used; the driver class comes from the
URL's jar on the classpath. A read with ``partition_column`` splits the key
range over ``num_partitions`` parallel queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.schemas import DIM_CUSTOMERS, DIM_SENSORS

SENSOR_COLUMNS = [f.name for f in DIM_SENSORS.fields]
CUSTOMER_COLUMNS = [f.name for f in DIM_CUSTOMERS.fields]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def read_table(spark: SparkSession, url: str, table: str, columns: list[str],
               partition_column: str | None = None, num_partitions: int = 8,
               properties: dict | None = None) -> DataFrame:
    # Spark's JDBC writer creates quoted (case-kept) column names; quote them back.
    query = f"(SELECT {', '.join(_q(c) for c in columns)} FROM {table}) t"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        bounds = (spark.read.format("jdbc").option("url", url)
                  .option("dbtable", f"(SELECT MIN({_q(partition_column)}) AS lo, MAX({_q(partition_column)}) AS hi FROM {table}) b")
                  .options(**(properties or {})).load().collect()[0])
        lo, hi = bounds[0], bounds[1]
        if lo is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lo)).option("upperBound", str(int(hi) + 1))
                      .option("numPartitions", str(num_partitions)))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append",
                properties: dict | None = None) -> None:
    """Bulk write (batched inserts per partition), never one statement per row."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", "10000")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def read_registry(spark: SparkSession, url: str, properties: dict | None = None) -> tuple[DataFrame, DataFrame]:
    sensors = read_table(spark, url, "dim_sensors", SENSOR_COLUMNS, "sensor_id", properties=properties)
    customers = read_table(spark, url, "customers", CUSTOMER_COLUMNS, properties=properties)
    return sensors, customers

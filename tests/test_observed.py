"""Checks counted by the writes equal those that scan the written tables."""
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import quality as qa
from sensorlake.sources.tables import stage_table

BRONZE = "reading_id string, sensor_id long, latitude double, longitude double, `values` string"
SILVER = "reading_id string, sensor_id long, ingested_at timestamp, sensor_type string"
REJECTED = "rejection_reason string"

DIRTY = [("a", 1, 10.0, 20.0, '{"P1": 1}'), ("a", -1, 91.0, 20.0, "{}"), (None, None, None, 200.0, "not json"), ("b", 0, -90.0, None, None)]


def tables(spark, rows):
    bronze = spark.createDataFrame(rows, BRONZE) if rows else spark.createDataFrame([], BRONZE)

    def silver(b):
        return b.select("reading_id", "sensor_id", F.lit(None).cast("timestamp").alias("ingested_at"),
                        F.when(F.col("sensor_id") > 0, "SDS011").otherwise("unheard-of").alias("sensor_type"))

    def rejected(b):
        return b.where("reading_id is null").select(F.lit(None).cast("string").alias("rejection_reason"))

    def marts(s):
        return {"temperature_by_region_day": s.select(F.col("ingested_at").alias("day"), F.col("sensor_type").alias("region"))}

    return bronze, silver, rejected, marts


@pytest.mark.parametrize("rows", [DIRTY, DIRTY * 50, []], ids=["dirty", "many", "empty"])
def test_equals_the_report_that_scans(spark, rows):
    bronze, silver, rejected, marts = tables(spark, rows)
    got = qa.observed_quality(bronze, silver, rejected, marts, stage_table)
    want = qa.quality_report(bronze, silver(bronze), rejected(bronze), marts(silver(bronze)))
    key = ["check", "table_name", "column_name", "failing_rows"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_only_uniqueness_is_scanned(spark, tmp_path):
    """The report's own plan reads the two id columns and nothing else."""
    bronze, silver, rejected, marts = tables(spark, DIRTY)
    bronze.write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.schema(BRONZE).parquet(str(tmp_path / "bronze"))
    got = qa.observed_quality(bronze, silver, rejected, marts, stage_table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert len(scans) == 2 and all("ReadSchema: struct<reading_id:string>" in line for line in scans)


def test_a_watched_table_is_stored_as_it_is(spark):
    bronze, *_ = tables(spark, DIRTY)
    report = qa.ObservedReport(spark)
    stored = stage_table(report.watch(bronze, "bronze"), "watched")
    assert sorted(map(str, stored.collect())) == sorted(map(str, bronze.collect()))
    found = {(r["check"], r["column_name"]): r["failing_rows"] for r in report.rows().collect()}
    assert found == {("range", "sensor_id"): 2, ("range", "latitude"): 1, ("range", "longitude"): 1,
                     ("valid_json", "values"): 2, ("non_empty_object", "values"): 1}

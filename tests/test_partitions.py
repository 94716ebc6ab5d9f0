"""Marker back-fill and readiness (own layout values)."""

from sensorlake.operators import partitions as pt
from sensorlake.schemas import BRONZE


def _bronze(spark, hours):
    rows = [("r", 1, "t", "", 0.0, 0.0, "", "{}", y, m, d, h) for (y, m, d, h) in hours]
    return spark.createDataFrame(rows, BRONZE)


def test_backfill_cases(spark):
    now = "2024-02-10 12:30:00"
    b = _bronze(spark, [("2024", "02", "10", "09"), ("2024", "02", "10", "10"), ("2024", "02", "10", "12"),
                        ("2024", "02", "07", "01")])
    status = pt.rollover_status(b, "2024-02-10 10:15:00")   # markers for 02-07 01 and 02-10 09
    assert sorted(tuple(r)[:4] for r in status.collect()) == [("2024", "02", "07", "01"), ("2024", "02", "10", "09")]
    missing = [tuple(r)[:4] for r in pt.missing_markers(b, status, now).collect()]
    # 10 has data and no marker -> marked; 09 has a marker -> skipped;
    # 11 has no data -> skipped; 12 is the current hour -> never
    assert missing == [("2024", "02", "10", "10")]
    ready = pt.ready_hours(b, pt.backfill(b, status, now))
    assert sorted(r.hour for r in ready.collect()) == ["01", "09", "10"]
    # outside the 48 h look-back a missing marker is not back-filled
    old = _bronze(spark, [("2024", "02", "07", "05")])
    assert pt.missing_markers(old, status, now).count() == 0


def test_listing_reads_no_bronze_and_backfill_runs_before_a_stream(spark):
    from pyspark.sql import functions as F

    from sensorlake.session import scratch_path
    from sensorlake.streaming.queries import backfill_status
    root, status = scratch_path(spark, "bronze"), scratch_path(spark, "status")
    rows = spark.createDataFrame([("a", 1, "t", "x", 0.0, 0.0, "DE", "{}", "2024", "05", "01", h) for h in ("07", "08", "09")], BRONZE)
    pt.write_bronze(rows, root)
    hours = pt.listed_hours(spark, root)
    plan = hours._jdf.queryExecution().toString()
    assert "Format: Parquet" not in plan and "content" not in plan.split("== Physical Plan ==")[1]
    assert sorted(r.hour for r in hours.collect()) == ["07", "08", "09"]
    assert pt.layout_violations(spark, root).count() == 0
    rows.write.parquet(f"{root}/year=2024/month=5/day=1/hour=7")
    assert pt.layout_violations(spark, root).count() > 0
    for _ in range(2):
        backfill_status(spark, root, status, "2024-05-01 09:30:00")
    assert sorted(r.hour for r in spark.read.parquet(status).where(F.col("has_data")).collect()) == ["07", "08"]

"""Data-quality checks as DataFrames: one aggregation pass per table.

Every check yields rows ``(check, table_name, column_name, failing_rows)``;
each check is an aggregate expression (mostly ``count_if``), all checks of a
table run in a single ``agg`` (partial aggregation, one row per task before
the exchange), then are unpivoted with ``stack`` so the report is one small
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.constants import ACCEPTED_SENSOR_TYPES, REJECTION_REASONS

# FIXED VALUES: not_null checks of the silver, rejected and gold tables.
NOT_NULL = {
    "silver": ["reading_id", "sensor_id", "ingested_at", "sensor_type"],
    "rejected": ["rejection_reason"],
    "pm25_by_country_hour": ["hour", "country", "avg_pm25"],
    "temperature_by_region_day": ["day", "region"],
    "sensor_activity_by_customer": ["day", "customer_name", "active_sensors"],
}
ACCEPTED = {
    ("silver", "sensor_type"): ACCEPTED_SENSOR_TYPES,
    ("rejected", "rejection_reason"): REJECTION_REASONS,
}


def _report(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate ``(check, column, failing-row aggregate)`` triples in one pass."""
    aggs = [agg.cast("bigint").alias(f"c{i}") for i, (_, _, agg) in enumerate(checks)]
    stack = "stack({}, {}) as (check, table_name, column_name, failing_rows)".format(
        len(checks), ", ".join(f"'{chk}', '{table}', '{col}', c{i}" for i, (chk, col, _) in enumerate(checks)))
    return df.agg(*aggs).selectExpr(stack)


def not_null_checks(table: str, columns: list[str]):
    return [("not_null", c, F.count_if(F.col(c).isNull())) for c in columns]


def accepted_checks(table: str):
    return [("accepted_values", col, F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(*values)))
            for (t, col), values in ACCEPTED.items() if t == table]


def unique_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows whose non-NULL key occurs more than once."""
    dup = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dup.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failing_rows")).select(
        F.lit("unique").alias("check"), F.lit(table).alias("table_name"), F.lit(key).alias("column_name"),
        "failing_rows")


def bronze_checks() -> list[tuple[str, str, Column]]:
    """Ranges, JSON validity, non-empty objects and the duplicate-id count.

    The duplicate count (rows minus distinct non-NULL ids; bronze keeps
    redeliveries) shares the pass: Spark plans the distinct as a partial
    aggregate on reading_id, so a hot id is combined map-side.
    """
    v = F.try_parse_json(F.col("values"))
    keys = F.try_variant_get(v, "$", "map<string,variant>")
    return [
        ("range", "sensor_id", F.count_if(~(F.col("sensor_id") > 0))),
        ("range", "latitude", F.count_if(~F.col("latitude").between(-90, 90))),
        ("range", "longitude", F.count_if(~F.col("longitude").between(-180, 180))),
        ("valid_json", "values", F.count_if(v.isNull())),
        ("non_empty_object", "values", F.count_if(v.isNotNull() & (F.coalesce(F.size(keys), F.lit(-1)) == 0))),
        ("duplicate_ids", "reading_id", F.count("reading_id") - F.count_distinct("reading_id")),
    ]


def quality_report(bronze: DataFrame, silver: DataFrame, rejected: DataFrame,
                   marts: dict[str, DataFrame]) -> DataFrame:
    parts = [
        _report(bronze, "bronze", bronze_checks()),
        _report(silver, "silver", not_null_checks("silver", NOT_NULL["silver"]) + accepted_checks("silver")),
        unique_check(silver, "silver", "reading_id"),
        _report(rejected, "rejected", not_null_checks("rejected", NOT_NULL["rejected"]) + accepted_checks("rejected")),
    ]
    for name, mart in marts.items():
        parts.append(_report(mart, name, not_null_checks(name, NOT_NULL[name])))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ObservedReport:
    """``quality_report`` without a scan per table: ``watch`` has a table's
    checks counted by the job that writes it. Uniqueness, which needs a distinct
    count, still reads the key column (``add``)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.seen, self.scans = spark, [], []

    def watch(self, df: DataFrame, table: str) -> DataFrame:
        """``df``, to be written or staged exactly once."""
        checks = bronze_checks()[:-1] if table == "bronze" else not_null_checks(table, NOT_NULL[table]) + accepted_checks(table)
        metrics = Observation()
        self.seen.append((table, checks, metrics))
        return df.observe(metrics, *[agg.cast("bigint").alias(f"c{i}") for i, (_, _, agg) in enumerate(checks)])

    def add(self, rows: DataFrame) -> None:
        self.scans.append(rows)

    def rows(self) -> DataFrame:
        """The report, once everything that is watched has been written. A
        table whose plan the optimizer found empty has failed no check."""
        found = [(check, table, column, int(metrics.get.get(f"c{i}") or 0))
                 for table, checks, metrics in self.seen for i, (check, column, _) in enumerate(checks)]
        out = self.spark.createDataFrame(found, "check string, table_name string, column_name string, failing_rows long")
        for rows in self.scans:
            out = out.unionByName(rows)
        return out


def observed_quality(bronze: DataFrame, silver_of, rejected_of, marts_of, store) -> DataFrame:
    """``quality_report`` of tables while they are built: ``silver_of`` and
    ``rejected_of`` make a table of bronze, ``marts_of`` the marts of silver, and
    ``store(frame, name)`` writes one and returns it as stored."""
    report = ObservedReport(bronze.sparkSession)
    silver = store(report.watch(silver_of(report.watch(bronze, "bronze")), "silver"), "silver")
    store(report.watch(rejected_of(bronze), "rejected"), "rejected")
    for name, mart in marts_of(silver).items():
        store(report.watch(mart, name), name)
    report.add(_report(bronze, "bronze", bronze_checks()[-1:]))
    report.add(unique_check(silver, "silver", "reading_id"))
    return report.rows()


def schema_checks(df: DataFrame, expected: T.StructType, required: list[str] | None = None) -> list[tuple]:
    """Column presence and type (extra columns allowed); metadata only."""
    have = {f.name: f for f in df.schema.fields}
    rows = []
    for f in expected.fields:
        got = have.get(f.name)
        rows.append(("column_type", f.name, f.dataType.simpleString(),
                     got.dataType.simpleString() if got else None,
                     bool(got and got.dataType == f.dataType)))
    for name in required or []:
        rows.append(("required_column", name, "present", "present" if name in have else "missing", name in have))
    return rows


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failing_rows): NULLs of each column, in one pass."""
    return _report(df, "", not_null_checks("", columns)).select("column_name", "failing_rows")


def future_timestamps(df: DataFrame, ts_col: Column, now) -> DataFrame:
    return df.agg(F.count_if(ts_col > F.lit(now).cast("timestamp")).alias("failing_rows"))

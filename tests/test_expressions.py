"""Expression-level behaviour on tiny frames (own values)."""

from pyspark.sql import functions as F

from sensorlake.functions.scalar import exact_avg, parse_instant
from sensorlake.operators import alerts, registry
from sensorlake.operators.silver import build_rejected, build_silver


def test_parse_instant_guards_and_offsets(spark):
    df = spark.createDataFrame([("2024-03-01T10:00:00+02:00",), ("10:00:00",), ("",), ("garbage",),
                                ("2024-13-45T00:00:00+00:00",), (None,)], "t string")
    out = [r[0] for r in df.select(parse_instant("t").cast("timestamp_ntz")).collect()]
    assert str(out[0]) == "2024-03-01 08:00:00"
    assert out[1:] == [None] * 5


def _bronze(spark, rows):
    return spark.createDataFrame(rows, "reading_id string, sensor_id bigint, sensor_type string, "
                                       "ingested_at string, latitude double, longitude double, "
                                       "country string, values string")


GOOD_TS = "2024-03-01T10:00:00+00:00"


def test_rejection_precedence_and_null_type(spark):
    b = _bronze(spark, [
        (None, 1, "test", "bad", 0.0, 0.0, "DE", "{}"),        # null id wins over the rest
        ("a", 1, "test", "bad", 0.0, 0.0, "DE", "{}"),         # then time
        ("b", 1, None, GOOD_TS, 0.0, 0.0, "DE", "{}"),         # NULL type is invalid
        ("c", 1, "", GOOD_TS, 0.0, 0.0, "DE", "{}"),
        ("d", 1, "SDS011", GOOD_TS, 0.0, 0.0, "DE", '{"P1": 1.5}'),
    ])
    reasons = {r.reading_id: r.rejection_reason for r in build_rejected(b).collect()}
    assert reasons == {None: "null_reading_id", "a": "unparseable_ingested_at",
                       "b": "invalid_sensor_type", "c": "invalid_sensor_type"}
    silver = build_silver(b).collect()
    assert [r.reading_id for r in silver] == ["d"] and silver[0].pm25 == 1.5
    assert len(silver) + len(reasons) == b.count()


def test_earliest_copy_wins_and_bad_json_is_null(spark):
    b = _bronze(spark, [
        ("x", 1, "SDS011", "2024-03-01T10:05:00+00:00", 0.0, 0.0, "DE", '{"P1": 2}'),
        ("x", 1, "SDS011", "2024-03-01T10:00:00+00:00", 0.0, 0.0, "DE", '{"P1": 1}'),
        ("y", 2, "SDS011", GOOD_TS, 0.0, 0.0, "DE", "not json"),
        ("z", 3, "SDS011", GOOD_TS, 0.0, 0.0, "DE", '{"P1": "n/a", "P2": "7"}'),
    ])
    rows = {r.reading_id: r for r in build_silver(b).collect()}
    assert rows["x"].pm25 == 1.0
    assert rows["y"].pm25 is None
    assert rows["z"].pm25 is None and rows["z"].pm10 == 7.0


def test_unfiltered_variant_collapses_null_ids(spark):
    b = _bronze(spark, [(None, 1, "SDS011", GOOD_TS, 0.0, 0.0, "DE", "{}"),
                        (None, 2, "SDS011", "bad", 0.0, 0.0, "DE", "{}")])
    assert build_silver(b, validate=False).count() == 1


def test_exact_avg_rounds_half_up(spark):
    df = spark.createDataFrame([(1.0005,), (1.0005,), (None,)], "x double")
    assert df.agg(exact_avg("x").alias("a")).first().a == 1.001
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(exact_avg("x").alias("a")).first().a is None


def test_exact_avg_of_what_is_no_plain_number(spark):
    nan, inf = float("nan"), float("inf")
    cases = {"nan": [1.0, nan], "inf": [1.0, inf], "both": [inf, -inf], "large": [2e12, 4e12], "huge": [3e30, 1.0], "none": [None], "some": [1.0, None, 2.0]}
    rows = [(k, x) for k, v in cases.items() for x in v]
    df = spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(exact_avg("x").alias("m"))
    got = {r.k: r.m for r in df.collect()}
    assert got["nan"] != got["nan"] and got["both"] != got["both"] and got["inf"] == inf
    assert got["large"] == 3e12 and got["huge"] == 1.5e30 and got["none"] is None and got["some"] == 1.5


def test_pressure_threshold(spark):
    vals = ['{"pressure": 130000}', '{"pressure": 130000.5}', '{"pressure": "150000"}',
            '{"pressure": "NaN"}', '{"pressure": "not-a-number"}', '{"pressure": true}', "{}"]
    df = spark.createDataFrame([(str(i), 1, v) for i, v in enumerate(vals)], "reading_id string, sensor_id bigint, values string")
    hits = sorted(r.reading_id for r in alerts.pressure_breaches(df).collect())
    assert hits == ["1", "2"]


def test_pressure_alert_without_customer_is_unknown(spark):
    df = spark.createDataFrame([("r1", 7, 1.0, 2.0, '{"pressure": 140000}')],
                               "reading_id string, sensor_id bigint, latitude double, longitude double, values string") \
        .withColumn("timestamp", F.current_timestamp())
    ds = spark.createDataFrame([(8, 1)], "sensor_id bigint, customer_id int")
    dc = spark.createDataFrame([(1, "C1", "Europe")], "customer_id int, customer_name string, region string")
    a = alerts.pressure_alerts(df, ds, dc).first()
    assert "customer=Unknown region=Unknown" in a.message
    assert "pressure=140000.0Pa (limit=130000Pa)" in a.message and "location=(1.0, 2.0)" in a.message


def test_unregistered_once_per_sensor(spark):
    silver = spark.createDataFrame(
        [(5, "DE", 1.0, 2.0, "SDS011", "2024-01-02 00:00:00"), (5, "AT", 1.0, 2.0, "SDS011", "2024-01-01 00:00:00"),
         (6, "DE", 1.0, 2.0, "SDS011", "2024-01-01 00:00:00"), (1, "DE", 1.0, 2.0, "SDS011", "2024-01-01 00:00:00")],
        "sensor_id bigint, country string, latitude double, longitude double, sensor_type string, ingested_at string") \
        .withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    ds = spark.createDataFrame([(1,)], "sensor_id bigint")
    first = alerts.unregistered_alerts(silver, ds)
    assert sorted(r.sensor_id for r in first.collect()) == [5, 6]
    assert first.where("sensor_id = 5").first().payload.find('"country":"AT"') > 0
    again = alerts.unregistered_alerts(silver, ds, alert_log=first)
    assert again.count() == 0


def test_region_and_customer_assignment(spark):
    df = spark.createDataFrame([
        (1, "DE", 0.0, 0.0), (2, "US", 85.0, -170.0), (3, "JP", 75.0, 180.0), (4, "BR", -20.0, -50.0),
        (-3, "XX", 86.0, -100.0), (-4, "FR", 0.0, 0.0)], "id bigint, country string, latitude double, longitude double") \
        .withColumn("sensor_type", F.lit("SDS011"))
    out = {r.sensor_id: (r.region, r.customer_id) for r in registry.dim_sensors_from_profiles(df).collect()}
    assert out[1] == ("Europe", 2)
    assert out[2] == ("North America", 3)
    assert out[3] == ("Asia-Pacific", 5)
    assert out[4] == ("Other", 6)
    assert out[-3] == ("Other", 6)
    assert out[-4] == ("Europe", 1)  # non-negative modulo: -4 mod 2 = 0


def test_value_ranges_rules(spark):
    df = spark.createDataFrame([([("P1", "10"), ("P2", "x"), ("", "3"), ("t", None), ("P1", "20")],)],
                               "v array<struct<value_type:string,value:string>>")
    m = df.select(registry.value_ranges(F.col("v")).alias("m")).first().m
    assert set(m) == {"P1", "t"}
    assert m["P1"].mean == 20.0 and m["P1"].std == 1.0
    assert m["t"].mean == 0.0 and m["t"].std == 0.5


def test_latest_per_sensor_ties_and_null_ids(spark):
    from sensorlake.schemas import SNAPSHOT_ENTRY
    rows = [(1, "2024-01-01", (10, ("A",)), ("1", "1", "DE"), [("P1", "1")]),
            (2, "2024-01-02", (10, ("B",)), ("1", "1", "DE"), [("P1", "1")]),
            (3, "2024-01-02", (10, ("C",)), ("1", "1", "DE"), [("P1", "1")]),
            (4, "2024-01-03", (None, ("D",)), ("1", "1", "DE"), [("P1", "1")])]
    snap = spark.createDataFrame(rows, SNAPSHOT_ENTRY)
    latest = registry.latest_per_sensor(snap).collect()
    assert len(latest) == 1 and latest[0].id == 3


def test_upsert_and_insert_if_absent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (3, "A")], "k bigint, v string")
    up = sorted(tuple(r) for r in registry.upsert(t, s, ["k"]).collect())
    assert up == [(1, "a"), (2, "B"), (3, "A")]
    ins = sorted(tuple(r) for r in registry.insert_if_absent(t, s, ["k"]).collect())
    assert ins == [(1, "a"), (2, "b"), (3, "A")]


def test_sample_is_exact_size(spark):
    df = spark.range(50)
    assert registry.sample(df, k=10).count() == 10
    assert registry.sample(df, k=100).count() == 50


def test_sync_columns(spark):
    from pyspark.sql import types as T
    from sensorlake.operators.merge import sync_columns
    df = spark.createDataFrame([(1, "x")], "a bigint, legacy string")
    model = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    out = sync_columns(df, model)
    assert out.columns == ["a", "b"] and out.first().b is None

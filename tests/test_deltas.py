"""Silver and marts kept by deltas, and increments by changed folders (own values)."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import deltas, gold
from sensorlake.operators import merge as mg
from sensorlake.operators.joins import Registry
from sensorlake.operators.silver import build_silver
from sensorlake.session import scratch_path
from sensorlake.sources import listing
from tests.test_scale_plans import FIRST, LANDINGS, _bronze, _dims, _land, _plan, _row

MANY = ([_row(f"r{i}", f"2024-03-0{1 + i % 4}T0{i % 7}:30:00+00:00", v, i % 5) for i, v in enumerate([1, 2, 2.0004, '"NaN"', '"4e24"', '"-Infinity"', 7, 8, 9, 2])],
        [_row(f"r{i}", f"2024-03-0{1 + i % 4}T0{i % 7}:{m}:00+00:00", v, i % 5) for i, (m, v) in enumerate([(29, 5), (31, 6), (30, 2), (10, 1), (20, 3), (30, 1), (30, 7), (59, 0)])])


def rows(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def both_ways(spark, cases, marts=tuple(gold.MARTS)):
    """A delta store after each landing, and a full build of them all."""
    ds, dc = _dims(spark)
    store = deltas.DeltaStore(spark, scratch_path(spark, "deltas"), Registry(ds, dc), marts, buckets=4)
    seen = []
    for batch, landing in enumerate(cases):
        seen += landing
        store.run(build_silver(_bronze(spark, landing), dedup=False), batch)
    silver = build_silver(_bronze(spark, seen))
    return store, silver, gold.build_marts(silver, ds, dc, marts)


@pytest.mark.parametrize("case", [*LANDINGS, "many"])
def test_equals_a_full_build(spark, case):
    first, second = MANY if case == "many" else LANDINGS[case][:2]
    marts = tuple(gold.MARTS) if case in ("many", "the only row of its day moves", "a copy of equal time") else ("sensor_activity_by_customer",)
    store, silver, full = both_ways(spark, [first, second, first] if case == "many" else [first, second], marts)
    assert rows(store.silver()) == rows(silver)
    for name, mart in full.items():
        assert rows(store.mart(name)) == rows(mart), name
    if case == "many":
        store.compact()
        for name, mart in full.items():
            assert rows(store.mart(name)) == rows(mart), name
        store.run(build_silver(_bronze(spark, [_row("r0", "2024-02-28T00:00:00+00:00", 4)]), dedup=False), 3)
        again = build_silver(_bronze(spark, first + second + [_row("r0", "2024-02-28T00:00:00+00:00", 4)]))
        assert rows(store.silver()) == rows(again)
        assert rows(store.mart("pm25_by_country_hour")) == rows(gold.build_marts(again, *_dims(spark))["pm25_by_country_hour"])


@pytest.mark.parametrize("step", ["apply_to_silver", "apply_to_index", "apply_to_mart"])
def test_a_broken_run_goes_on_from_its_changes(spark, monkeypatch, step):
    first, second = MANY
    name = "temperature_by_region_day" if step == "apply_to_index" else "pm25_by_country_hour"
    store, silver, full = both_ways(spark, [first], [name])
    real = getattr(deltas.DeltaStore, step)

    def breaks(self, *args):
        real(self, *args)
        raise OSError("lost")

    batch = build_silver(_bronze(spark, second), dedup=False)
    monkeypatch.setattr(deltas.DeltaStore, step, breaks)
    with pytest.raises(OSError):
        store.run(batch, 1)
    monkeypatch.setattr(deltas.DeltaStore, step, real)
    for _ in range(2):  # the second call finds the batch done
        store.run(batch, 1)
    silver = build_silver(_bronze(spark, first + second))
    assert rows(store.silver()) == rows(silver)
    assert rows(store.mart(name)) == rows(gold.build_marts(silver, *_dims(spark), [name])[name])
    assert not os.listdir(f"{store.root.removeprefix('file:')}/changes")


def test_marts_follow_a_changed_registry(spark):
    ds, dc = _dims(spark)
    first, second = MANY
    name = "sensor_activity_by_customer"
    store, _, _ = both_ways(spark, [first], [name])
    other = dc.withColumn("customer_name", F.lit("Renamed"))
    store.registry = Registry(ds, other)
    store.run(build_silver(_bronze(spark, second), dedup=False), 1)
    silver = build_silver(_bronze(spark, first + second))
    assert rows(store.mart(name)) == rows(gold.build_marts(silver, ds, other, [name])[name])


def test_plans_read_what_changed(spark):
    first, second = MANY
    store, _, _ = both_ways(spark, [first, second], ["pm25_by_country_hour"])
    some = store.index_of([1, 3])
    assert "bucket" in _plan(some).split("PartitionFilters:")[1].split("]")[0]
    read = [r[0] for r in some.select(F.input_file_name()).distinct().collect()]
    assert read and all("/bucket=1/" in f or "/bucket=3/" in f for f in read)
    changes = spark.createDataFrame([], deltas.CHANGES)
    spec = deltas.MARTS["pm25_by_country_hour"]
    scans = _plan(spec.state_of(store.mart_changes("pm25_by_country_hour", changes))) + _plan(store.mart("pm25_by_country_hour"))
    assert "/silver" not in scans
    days = _plan(store.mart("pm25_by_country_hour", ["2024-03-01"]))
    assert days.count("PartitionFilters: [part_day") + days.count("PartitionFilters: [isnotnull(part_day") == 2


def test_added_readings_rewrite_no_file(spark):
    store, _, _ = both_ways(spark, [FIRST], [])
    files = lambda: {f for f in mg.list_files(spark, f"{store.root}/silver").select("path").toPandas()["path"]}
    before = files()
    store.run(build_silver(_bronze(spark, [_row("b", "2024-03-01T10:40:00+00:00"), _row("a", "2024-03-01T10:45:00+00:00")]), dedup=False), 1)
    after = files()
    assert before < after and len(after) == len(before) + 1
    store.run(build_silver(_bronze(spark, [_row("a", "2024-03-01T10:45:00+00:00")]), dedup=False), 2)  # a later copy
    assert files() == after
    store.run(build_silver(_bronze(spark, [_row("a", "2024-03-01T09:45:00+00:00")]), dedup=False), 3)  # an earlier one
    assert not before & files() and len(files() & after) == 1


def test_only_changed_folders_are_listed(spark, monkeypatch):
    root, log = scratch_path(spark, "bronze"), listing.FileLog(spark, scratch_path(spark, "log"), grace_ms=-1)
    seen = []
    real = listing.list_folders
    monkeypatch.setattr(listing, "list_folders", lambda s, folders: seen.append(len(folders)) or real(s, folders))

    def take():
        found = log.new_files(root)
        n = found.files.count()
        log.commit(found)
        return n

    for hour in ("08", "09", "10", "11"):
        _land(spark, root, FIRST, hour)
    assert take() == 4 and seen == [4]
    assert take() == 0 and seen == [4]
    _land(spark, root, [_row("late", "2024-03-01T08:00:00+00:00")], "08")
    assert take() == 1 and seen == [4, 1]
    log.compact()
    assert take() == 0 and seen == [4, 1]
    _land(spark, root, FIRST, "12")
    found = log.new_files(root)  # breaks off before it is logged
    assert found.files.count() == 1 and take() == 1 and take() == 0


def test_a_folder_that_has_just_changed_is_listed_again(spark):
    root, log = scratch_path(spark, "bronze"), listing.FileLog(spark, scratch_path(spark, "log"), grace_ms=10**9)
    _land(spark, root, FIRST)
    found = log.new_files(root)
    log.commit(found)
    again = log.new_files(root)
    assert len(again.folders) == 1 and again.files.count() == 0


def test_refresh_by_changed_folders(spark):
    ds, dc = _dims(spark)
    name = "pm25_by_country_hour"
    root, store = scratch_path(spark, "bronze"), deltas.DeltaStore(spark, scratch_path(spark, "deltas"), Registry(ds, dc), [name])
    first, second, hour = LANDINGS["an earlier copy on another day"]
    _land(spark, root, first)
    store.refresh(root)
    _land(spark, root, second, hour)
    store.refresh(root)
    store.refresh(root)
    silver = build_silver(_bronze(spark, first + second))
    assert rows(store.silver()) == rows(silver) and store.next_batch() == 2
    assert rows(store.mart(name)) == rows(gold.build_marts(silver, ds, dc, [name])[name])


def test_a_run_stages_only_the_rivals_beside_its_increment(spark, monkeypatch):
    staged, plain = [], deltas.stage_table

    def record(df, name):
        out = plain(df, name)
        staged.append((name, out.count()))
        return out
    monkeypatch.setattr(deltas, "stage_table", record)
    at = "2024-03-01T10:%02d:00+00:00"
    store, _, _ = both_ways(spark, [[_row(f"r{i}", at % 30) for i in range(20)]], [])
    assert not [name for name, _ in staged if name in ("increment", "known", "rivals")]   # a new store has nothing to look up
    staged.clear()
    second = [_row(f"s{i}", at % 30) for i in range(20)] + [_row("r1", at % 20), _row("r2", at % 40)]
    store.run(build_silver(_bronze(spark, second), dedup=False), 1)
    held = dict(staged)
    assert (held["increment"], held["known"], held["rivals"], held["better"]) == (22, 2, 1, 1)
    assert store.silver().count() == 40


def test_a_large_bucket_is_written_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        store = deltas.DeltaStore(spark, scratch_path(spark, "deltas"), buckets=1)
        rows_ = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("sign"), F.col("id").cast("string").alias("reading_id"), F.lit("2024-03-01 10:00:00").cast("timestamp").alias("ingested_at"),
                                                    F.lit("2024-03-01").alias("day"), F.lit("10").alias("hour"), F.lit(0).cast("long").alias("batch"))
        store.apply_to_index(rows_)
        assert store.index_of([0]).count() == 20_000
        assert store.index_of([0]).select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")

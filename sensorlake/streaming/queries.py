"""Streaming pipelines over a message frame.

- ``ingest``: one query, one decode, two sinks idempotent by batch id.
- ``bronze``: decode -> Hive-partitioned Parquet file sink (exactly-once via
  the sink's commit log) plus a dead-letter file sink.
- ``silver_dedup``: each batch is merged into stored silver by the hours it
  touches, with the same order of copies as the batch build. No watermark is
  involved: first deliveries of any age are kept, a clock in the future stops
  nothing, and an earlier copy replaces a later one whenever it comes.
- ``hourly``: after that merge, the days of the touched hours are recounted;
  ``hourly_delta`` appends partial aggregates of what the merge changed instead.
- ``first_seen``: unregistered sensors by keyed state, without the log.
- ``pressure_alerts`` / ``unregistered_alerts``: ``foreachBatch`` writes a
  batch's alerts, if it raised any, to a folder of its own; a replayed batch
  replaces it. The registry is read anew for each batch.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorlake.functions.scalar import exact_avg
from sensorlake.operators import alerts as al
from sensorlake.operators.decode import alert_readings, decode, decoded, parsed_bronze, split
from sensorlake.operators.deltas import DeltaStore
from sensorlake.operators.joins import Registry
from sensorlake.operators.merge import clear_partitions, merge_silver, of_days, read_stored_silver, replace_partitions
from sensorlake.operators.partitions import hour_start, listed_hours, missing_markers
from sensorlake.operators.silver import build_silver
from sensorlake.schemas import ALERT_LOG, PARTITION_COLUMNS, PARTITION_STATUS
from sensorlake.session import path_exists, remove_path
from sensorlake.sources.tables import staged_path

BATCH_LOG = T.StructType(ALERT_LOG.fields + [T.StructField("batch_id", T.LongType())])
# Called for each batch, so that a sensor registered meanwhile is known.
RegistrySource = Callable[[SparkSession], Registry]


def _start(writer, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def bronze(messages: DataFrame, bronze_path: str, dead_path: str, checkpoint: str,
           trigger: dict | None = None) -> list[StreamingQuery]:
    """Two file sinks, each a query of its own that decodes the topic;
    ``ingest`` has both from one. Partitions come from the arrival clock."""
    b, dead = decode(messages)
    b = b.observe("bronze", F.count(F.lit(1)).alias("rows"))
    dead = dead.observe("dead_letter", F.count(F.lit(1)).alias("rows"))
    q1 = _start(b.drop("_arrival").writeStream.format("parquet").partitionBy(*PARTITION_COLUMNS)
                .option("path", bronze_path), f"{checkpoint}/bronze", trigger)
    q2 = _start(dead.writeStream.format("parquet").option("path", dead_path), f"{checkpoint}/dead", trigger)
    return [q1, q2]


def publish_batch(spark: SparkSession, staged: str, target: str, batch_id: int) -> None:
    """Move a staged batch's files into the hour folders of ``target`` under
    names of the batch; those of an earlier try are removed first. One rename a
    file: as many as the batch has hours and writers."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(conf)
    hours = "year=*/month=*/day=*/hour=*"
    for old in fs.globStatus(path(f"{target}/{hours}/batch-{batch_id:012d}-*.parquet")) or []:
        fs.delete(old.getPath(), False)
    found = sorted(s.getPath().toString() for s in fs.globStatus(path(f"{staged}/{hours}/*.parquet")) or [])
    for number, name in enumerate(found):
        folder = path("/".join([target, *name.split("/")[-5:-1]]))
        fs.mkdirs(folder)
        if not fs.rename(path(name), path(folder, f"batch-{batch_id:012d}-{number:06d}.parquet")):
            raise OSError(f"cannot move {name} to {folder}")
    fs.delete(path(staged), True)


def ingest(messages: DataFrame, bronze_path: str, dead_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Bronze and dead letters from one query and one decode: each batch is
    decoded once, kept while both sinks are written, and let go. Both sinks are
    idempotent by batch id: dead letters by their own partition, bronze by file
    names of the batch, so the hour layout stays as it is."""
    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            b, dead = split(df)
            staged = f"{bronze_path.rstrip('/')}__batch-{batch_id}"
            b.drop("_arrival").hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(staged)
            publish_batch(spark, staged, bronze_path.rstrip("/"), batch_id)
            _write_batch(dead, dead_path, batch_id)
        finally:
            df.unpersist()

    return _start(decoded(messages).writeStream.foreachBatch(run), checkpoint, trigger)


class StageCounts(StreamingQueryListener):
    """Stage counters (A8): the ``observe`` metrics of every batch, which come
    with its progress event and cost no job. Register it with
    ``spark.streams.addListener`` before the queries start; a batch that is
    reported twice counts once."""

    def __init__(self):
        self._rows: dict[tuple, int] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event):  # noqa: N802 - the listener's interface
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        with self._lock:
            for name, row in (p.observedMetrics or {}).items():
                self._rows[str(p.id), p.batchId, name] = int(row["rows"])

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def totals(self) -> dict[str, int]:
        out: dict[str, int] = {}
        with self._lock:
            for (_, _, name), n in self._rows.items():
                out[name] = out.get(name, 0) + n
        return out


def _silver_rows(messages: DataFrame) -> DataFrame:
    """Typed rows that silver accepts, copies and all. Part of the stream's own
    plan, so that what silver does not use is never computed."""
    return build_silver(parsed_bronze(messages), dedup=False)


def silver_dedup(messages: DataFrame, silver_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Stored silver, kept equal to a batch build over all messages so far. A
    replayed batch merges the same rows again, which changes nothing."""
    def run(df: DataFrame, batch_id: int) -> None:
        touched = merge_silver(df.sparkSession, df, silver_path)
        remove_path(df.sparkSession, staged_path(touched))

    return _start(_silver_rows(messages).writeStream.foreachBatch(run), checkpoint, trigger)


def _write_batch(df: DataFrame, target: str, batch_id: int) -> None:
    """Idempotent micro-batch append: the batch's rows go to their own
    ``batch_id=N`` partition with dynamic partition overwrite, so a replayed
    batch replaces its earlier output. A batch without rows writes nothing."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target))


def read_alert_log(spark: SparkSession, path: str, schema: T.StructType = BATCH_LOG) -> DataFrame:
    """The log by its own schema: it may have no file yet."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def pressure_alerts(messages: DataFrame, registry: RegistrySource, alert_path: str, checkpoint: str,
                    trigger: dict | None = None, notify=None) -> StreamingQuery:
    """Every breach, with the customer that the registry names at the time.

    ``notify(batch_df)`` (optional) delivers the batch's alerts, e.g. to a
    webhook, after they are logged; a delivery that fails is reported but does
    not undo or block the logging.
    """
    rows = alert_readings(messages)

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        found = al.pressure_alerts(df, registry(spark), None)
        log = T.StructType(found.schema.fields + [T.StructField("batch_id", T.LongType())])
        _write_batch(found, alert_path, batch_id)
        if notify is None:
            return
        batch = read_alert_log(spark, alert_path, log).where(F.col("batch_id") == batch_id)
        if batch.limit(1).count():
            try:
                notify(batch)
            except Exception as exc:  # noqa: BLE001 - delivery must not stop logging
                print(f"alert delivery failed for batch {batch_id}: {exc}")

    return _start(rows.writeStream.foreachBatch(run), checkpoint, trigger)


def unregistered_alerts(messages: DataFrame, registry: RegistrySource, alert_path: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """First message of an unregistered sensor raises one alert, ever. The log
    has a row per such sensor and a folder only for batches that added one."""
    rows = alert_readings(messages)

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        # earlier batches only: a replayed batch recomputes its own alerts
        log = read_alert_log(spark, alert_path).where(F.col("batch_id") != batch_id)
        _write_batch(al.first_messages(df, registry(spark), log), alert_path, batch_id)

    return _start(rows.writeStream.foreachBatch(run), checkpoint, trigger)


def first_seen(messages: DataFrame, registry: RegistrySource, alert_path: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """One alert for each unregistered sensor, when it is first seen.

    The sensors seen are keyed state of the stream (RocksDB, in the
    checkpoint): ``dropDuplicates`` lets an id through once, ever, and no batch
    reads the alert log. State has a row for each sensor that was unregistered
    when the query last started; the registry is asked anew for those that a
    batch lets through. Of several messages of a sensor in its first batch any
    one is the payload."""
    known = registry(messages.sparkSession).known_ids
    rows = alert_readings(messages).join(known, "sensor_id", "left_anti").dropDuplicates(["sensor_id"])

    def run(df: DataFrame, batch_id: int) -> None:
        _write_batch(al.first_messages(df, registry(df.sparkSession), None), alert_path, batch_id)

    return _start(rows.writeStream.foreachBatch(run), checkpoint, trigger)


def hourly_counts(silver: DataFrame) -> DataFrame:
    return (silver.groupBy(F.date_trunc("hour", "ingested_at").alias("hour"), "sensor_type")
            .agg(F.count(F.lit(1)).alias("reading_count"), exact_avg("pm25").alias("avg_pm25")))


def hourly(messages: DataFrame, silver_path: str, target: str, checkpoint: str,
           trigger: dict | None = None) -> StreamingQuery:
    """Readings per (hour, sensor_type) of stored silver, kept current: each
    batch is merged into silver, then the days that it touched are recounted
    (only their partitions are read) and days left empty are removed."""
    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        touched = merge_silver(spark, df, silver_path)
        days = touched.select("day").distinct()
        rows = of_days(read_stored_silver(spark, silver_path), touched)
        counts = hourly_counts(rows).withColumn("part_day", F.date_format("hour", "yyyy-MM-dd"))
        replace_partitions(spark, counts, target, ["part_day"])
        left = rows.select("day").distinct()
        clear_partitions(spark, target, days.join(left, "day", "left_anti").withColumnRenamed("day", "part_day"))
        remove_path(spark, staged_path(touched))

    return _start(_silver_rows(messages).writeStream.foreachBatch(run), checkpoint, trigger)


def hourly_delta(messages: DataFrame, store: DeltaStore, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """``hourly`` by partial aggregates: a batch appends sums and counts of the
    rows that it adds to silver or takes from it; no day is counted again. The
    batch id makes a replay harmless."""
    def run(df: DataFrame, batch_id: int) -> None:
        # the store of the stream's own session, with the batch's conf
        DeltaStore(df.sparkSession, store.root, store.registry, store.marts).run(df, batch_id)

    return _start(_silver_rows(messages).writeStream.foreachBatch(run), checkpoint, trigger)


def republish(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """Re-keyed messages (key = sensor id text) to a Kafka topic.

    Offsets of the source and the sink's progress live in the checkpoint; the
    producer is idempotent, so a retried batch does not duplicate records
    within a producer session (Kafka sinks are at-least-once across restarts;
    silver's dedup removes such copies). Needs the Kafka connector on the
    classpath, which this sandbox does not have.
    """
    from sensorlake.operators.decode import rekey
    w = (rekey(messages).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
         .option("kafka.enable.idempotence", "true").option("kafka.acks", "all"))
    return _start(w, checkpoint, trigger)


def run_to_end(queries: list[StreamingQuery] | StreamingQuery) -> None:
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def backfill_status(spark: SparkSession, bronze_path: str, status_path: str, now) -> None:
    """What the ingest does before it starts: closed hours of the look-back
    that hold files and have no status row get one."""
    status = read_alert_log(spark, status_path, PARTITION_STATUS)
    missing_markers(listed_hours(spark, bronze_path), status, now).write.mode("append").parquet(status_path)


def rollover_status(messages: DataFrame, hours_path: str, status_path: str, checkpoint: str,
                    trigger: dict | None = None, bronze_path: str | None = None, now=None) -> StreamingQuery:
    """Close hour partitions as the stream moves past them; with ``bronze_path``
    those that an earlier run left open as of ``now`` are closed first.

    Each micro-batch takes the hours it holds data for plus the hours still
    open after the previous batch (``hours_path/batch_id=N-1``); every hour
    older than the newest of them gets one status row (``closed_at`` = the
    hour's end), and the newest hour(s) are written as the open set of this
    batch (``batch_id=N``). The per-batch work is one batch plus a handful of
    open hours, however long the stream runs. Batch ids are consecutive and a
    replayed batch reads the same previous open set and overwrites its own;
    the anti join against the status table makes a replay harmless.
    """
    if bronze_path is not None:
        backfill_status(messages.sparkSession, bronze_path, status_path, now or F.current_timestamp())
    b, _ = decode(messages)
    key = F.concat(*[F.col(c) for c in PARTITION_COLUMNS])

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        hours = df.select(*PARTITION_COLUMNS).distinct()
        previous = f"{hours_path}/batch_id={batch_id - 1}"
        if batch_id > 0 and path_exists(spark, previous):
            hours = hours.unionByName(spark.read.parquet(previous).select(*PARTITION_COLUMNS)).distinct()
        hours = hours.persist()    # a handful of rows; the batch is decoded once, not per action
        try:
            newest = hours.agg(F.max(key).alias("k")).first()["k"]   # one literal: yyyyMMddHH
            if newest is None:
                return
            closed = (hours.where(key < F.lit(newest))
                      .select(*PARTITION_COLUMNS, F.lit(True).alias("has_data"),
                              (hour_start() + F.expr("INTERVAL 1 HOUR")).alias("closed_at")))
            if path_exists(spark, status_path):
                closed = closed.join(spark.read.schema(PARTITION_STATUS).parquet(status_path).select(*PARTITION_COLUMNS),
                                     PARTITION_COLUMNS, "left_anti")
            closed.write.mode("append").parquet(status_path)
            _write_batch(hours.where(key >= F.lit(newest)), hours_path, batch_id)
        finally:
            hours.unpersist()

    return _start(b.select(*PARTITION_COLUMNS).writeStream.foreachBatch(run), checkpoint, trigger)

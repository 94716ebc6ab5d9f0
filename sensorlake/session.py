"""Session construction and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every entry point relies on: instants are truncated in UTC, AQE
# re-plans joins and partition counts from runtime sizes, skewed join
# partitions are split. Streaming state (dedup keys within the watermark
# delay, hourly windows) lives in RocksDB: off-heap, spilled to local disk,
# checkpointed incrementally as changelogs, so days of keys do not have to
# fit in executor heap.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "sensorlake",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    settings["spark.ui.enabled"] = "false"
    settings["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    return spark


MB = 1 << 20
GB = 1 << 30


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Scan split and shuffle sizes for a job reading ``input_bytes``.

    - Scan splits: 128 MB, or 512 MB from 10 TB up, so a 100 TB scan is about
      200k map tasks rather than 800k (Parquet decodes a few times larger in
      memory; 512 MB stays within one core's share of a typical executor).
    - Shuffle partitions: about 1 GB of input per reducer, at least two waves
      over the cores and at most 100k, which keeps the map x reduce block count
      manageable. AQE then coalesces small reducers to 256 MB and splits
      skewed ones, so the figure is a ceiling, not a guess to get exactly right.
    """
    split = 512 * MB if input_bytes >= 10 * (1 << 40) else 128 * MB
    reducers = min(100_000, max(2 * total_cores, math.ceil(input_bytes / GB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of files under ``paths`` from file-system metadata (no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        total += hpath.getFileSystem(conf).getContentSummary(hpath).getLength()
    return int(total)


@contextmanager
def sized_for(spark: SparkSession, paths: list[str]):
    """``scale_settings`` for the files a job reads, for as long as it runs."""
    settings = scale_settings(input_bytes(spark, paths), spark.sparkContext.defaultParallelism)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield settings
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def use_utc(spark: SparkSession) -> None:
    """All hour/day truncation is in UTC (readings carry their own offset)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to storage every executor can
    reach; a machine-local folder would vanish with the executor that wrote
    it, so outside local mode an unset value is an error. Only local runs
    and tests get a fresh folder of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage "
                             "(HDFS, S3, ...) that every executor can reach")
        root = tempfile.mkdtemp(prefix="sensorlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sensorlake/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library staged, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder within its file system; an error if that is refused."""
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {path} to {to}")


__all__ = ["get_session", "use_utc", "checkpoint_root", "scratch_path",
           "path_exists", "remove_path", "rename_path", "SESSION_DEFAULTS", "scale_settings",
           "input_bytes", "sized_for"]


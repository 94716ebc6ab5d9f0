"""Landed files found by the folders that changed.

An hour folder's modification time moves when a file lands in it. One glob
lists the hour folders (not their files) with those times; only folders whose
time differs from the log's are listed for files. A late file in an old hour
moves that hour's folder and is found like any other.

Folder times need a file system that keeps them (HDFS, a local disk). On an
object store without them use ``merge.new_files``, which compares file names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.operators.partitions import HOUR_FOLDERS
from sensorlake.session import path_exists, remove_path, rename_path, scratch_path
from sensorlake.sources.tables import stage_table, staged_path

FOLDERS = T.StructType([T.StructField("folder", T.StringType()), T.StructField("modified", T.LongType()), T.StructField("run", T.LongType())])
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("folder_day", T.StringType())])
LAYOUT_GLOB = "year=*/month=*/day=*/hour=*"
#: A folder that changed so shortly before it was listed may change again
#: within the same tick of its clock; it is looked at once more.
GRACE_MS = 2_000
#: Files of the folder log from which it is written anew.
COMPACT_FILES = 64


def hour_folders(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the hour folders: folder metadata
    only, one row an hour, whatever the number of files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{LAYOUT_GLOB}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(path) or [] if s.isDirectory()]


def list_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(path, length) of the Parquet files in some folders; none is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders).select("path", "length")


@dataclass
class Increment:
    """New files (staged: path, length) and the folders that were listed."""
    files: DataFrame
    folders: list[tuple[str, int]]
    run: int


class FileLog:
    """Which folders and files have been processed: two small tables under
    ``path``. Both are written by ``commit``, when the run is done."""

    def __init__(self, spark: SparkSession, path: str, grace_ms: int = GRACE_MS):
        self.spark, self.path, self.grace_ms = spark, path.rstrip("/"), grace_ms

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def new_files(self, root: str) -> Increment:
        """Files that no run has processed, from the changed folders."""
        spark, now = self.spark, int(time.time() * 1000)
        log = self._table("folders", FOLDERS)
        known = {r["folder"]: (r["last"]["modified"], r["last"]["run"]) for r in
                 log.groupBy("folder").agg(F.max_by(F.struct("modified", "run"), "run").alias("last")).collect()}  # a row an hour
        run = 1 + max((x[1] for x in known.values()), default=-1)
        changed = [(p, t) for p, t in hour_folders(spark, root) if known.get(p, (None,))[0] != t]
        if changed:
            files = list_folders(spark, [p for p, _ in changed])
            days = files.select(folder_day().alias("d")).distinct()
            done = self._table("files", FILES).where(F.col("folder_day").isin([r["d"] for r in days.collect()])).select("path")
            files = files.join(done, "path", "left_anti")
        else:
            files = spark.createDataFrame([], "path string, length long")
        return Increment(stage_table(files, "new_files"), [(p, -1 if now - t < self.grace_ms else t) for p, t in changed], run)

    def commit(self, found: Increment) -> None:
        """Log the files first: a break before the folders are logged has them
        listed again, without their files being taken twice."""
        spark = self.spark
        (found.files.select("path", folder_day().alias("folder_day")).write.mode("append").partitionBy("folder_day").parquet(f"{self.path}/files"))
        if found.folders:
            spark.createDataFrame([(p, t, found.run) for p, t in found.folders], FOLDERS).coalesce(1).write.mode("append").parquet(f"{self.path}/folders")
        remove_path(spark, staged_path(found.files))
        if found.run % COMPACT_FILES == COMPACT_FILES - 1:
            self.compact()

    def compact(self) -> None:
        """One row for each folder, written aside and swapped in."""
        log, aside, old = f"{self.path}/folders", scratch_path(self.spark, "folders"), scratch_path(self.spark, "old_folders")
        if not path_exists(self.spark, log):
            return
        last = self._table("folders", FOLDERS).groupBy("folder").agg(F.max_by(F.struct("modified", "run"), "run").alias("last"))
        last.select("folder", "last.*").coalesce(1).write.parquet(aside)
        rename_path(self.spark, log, old)
        rename_path(self.spark, aside, log)
        remove_path(self.spark, old)


def folder_day(path: str = "path"):
    """yyyy-MM-dd of the hour folder that a file lies in."""
    return F.concat_ws("-", *[F.regexp_extract(path, HOUR_FOLDERS, i) for i in (1, 2, 3)])

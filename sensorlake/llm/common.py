"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.session import remove_path, scratch_path

#: Most rows of a broadcast side; a larger side is joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Most bytes of a broadcast side that holds texts or arrays.
BROADCAST_BYTES = 64 << 20
#: Rows of an Arrow batch handed to Python; texts can be long.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows, as texts can be long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables staged in the shared folder, so that a lost executor costs the
    tasks it ran and not the whole lineage. ``drop`` deletes one when nothing
    reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, scratch_path(spark, name), {}
        self.count = itertools.count()

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self.count)}-{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self.paths.pop(id(df), (None, None))
            if path:
                remove_path(self.spark, path)


def if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table, marked for broadcast only if it has ``limit`` rows or
    fewer; ids and hashes only, so the row bound is a size bound."""
    return F.broadcast(df) if df.count() <= limit else df


def payload(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value, however nested; fixed ones count eight."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        size = sum((payload(value[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + payload(x, kind.elementType))
    else:
        size = F.lit(0)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long")) + 8


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table, marked for broadcast only if its rows and their bytes
    are within bounds: for sides with texts or arrays."""
    if df.count() > rows:
        return df
    size = sum((payload(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def beside(df: DataFrame, side: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``side`` with column names that ``df`` has none of, and its columns."""
    names = [free_name(df, f"side_{c}") for c in side.columns]
    return side.toDF(*names), [F.col(f"`{c}`") for c in names]


def sorted_blocks(batches: Iterator[pa.RecordBatch], key: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """A stream sorted by ``key``, in tables that never split a key's rows."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < rows:
            continue
        cut = last_start(held, key)
        if cut:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def last_start(t: pa.Table, key: list[str]) -> int:
    """Where the last key's rows begin."""
    return int(starts(t, key)[-1])


def starts(t: pa.Table, key: list[str]) -> np.ndarray:
    """Row numbers at which the key changes, from 0; the keys are not null."""
    change = np.zeros(t.num_rows, bool)
    if t.num_rows:
        change[0] = True
    for k in key:
        v = t.column(k).to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a shared folder and the path in it."""
    uri = uri.replace("s3a://", "s3://", 1)
    if "://" not in uri:
        uri = uri.removeprefix("file:")
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


class Commit:
    """A file written under a temporary name and moved to its own name when
    whole. A task run twice writes the same bytes under the same last name."""

    def __init__(self, folder: str, name: str):
        self.fs, root = filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.last, self.tmp = f"{root}/{name}", f"{root}/_tmp-{uuid.uuid4().hex}-{name}"
        self.out, self.size = self.fs.open_output_stream(self.tmp, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.last)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of a number's text, modulo n."""
    return F.crc32(col.cast("string").cast("binary")) % n

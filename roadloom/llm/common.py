"""Shared helpers: durable intermediate tables, and Arrow text columns as numpy buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship

__all__ = ["CHUNK_BYTES", "Durable", "freed_shuffles", "shared_dir", "ship", "table", "text_buffer", "text_chunks", "unlike"]

#: Bytes of text that one numpy pass handles; bounds the memory of a Python worker.
CHUNK_BYTES = 1 << 20

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, a temporary one, but only if driver
    and executors are one process (tests): elsewhere such a folder would lose data."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="roadloom-"))
    return _own_dir[0]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes a query's shuffle files as soon as the query ends: what it wrote stands for them."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Durable:
    """A DataFrame written as Parquet in the shared folder, so that a lost executor costs no recomputation."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        schema = df.schema
        with freed_shuffles(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        """Free the files once nothing reads them any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unlike(name: str, columns: list[str]) -> str:
    """A column name like `name` that none of the columns has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def text_chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about `limit` bytes of text (a longer text makes a slice of its own)."""
    data, offsets = text_buffer(batch.column(batch.schema.names.index(text)))
    start, n = 0, batch.num_rows
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        end = min(end, n)
        yield batch.slice(start, end - start), data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


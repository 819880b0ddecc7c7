"""Helpers for Arrow tasks: bounded slices of a batch, join sides of a proven size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.session import scratch_path

SLICE_BYTES = 2 << 20


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each slice; a
    longer value is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def released(work: Callable[..., Iterator[pa.RecordBatch]]):
    """A task's function that gives its free memory back to the system when it is done:
    workers are reused, and what a stage leaves behind counts against the next one."""

    @wraps(work)
    def run(*args) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(*args)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


class Stages:
    """Intermediates in the shared folder, well compressed, dropped when they have served."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            drop_path(self.spark, self.paths.pop(name))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of this application has written below the shared one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a summary whose rows have been counted; a larger one stays
    a plain join side, which adaptive execution shuffles and splits."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

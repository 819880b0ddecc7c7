"""Element-wise sums of fixed-length arrays by key, mergeable."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAN = object()
CELLS = 1 << 21  # sums a task holds before it hands them on


class Totals:
    """Sum and count of the present elements at each position, by key."""

    def __init__(self):
        self.held: dict = {}
        self.cells = 0

    def add(self, key, sums: np.ndarray, counts: np.ndarray) -> None:
        key = self.named(key)
        old = self.held.get(key, (np.zeros(0), np.zeros(0, np.int64)))
        self.cells += max(len(sums) - len(old[0]), 0)
        if len(old[0]) >= len(sums):
            (sums, counts), old = old, (sums, counts)
        # the longer arrays take the shorter ones in
        sums[:len(old[0])] += old[0]
        counts[:len(old[1])] += old[1]
        self.held[key] = (sums, counts)

    @staticmethod
    def named(key):
        """NaN is one key although it does not equal itself."""
        return NAN if isinstance(key, float) and key != key else key

    def has(self, key) -> bool:
        return self.named(key) in self.held

    def drain(self, kind: pa.DataType) -> pa.RecordBatch:
        keys = [float("nan") if k is NAN else k for k in self.held]
        sums, counts = zip(*self.held.values()) if self.held else ((), ())
        self.held, self.cells = {}, 0
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, kind), pa.array(sums, pa.list_(pa.float64())),
             pa.array(counts, pa.list_(pa.int64()))],
            ["key", "sums", "counts"],
        )


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(elements, lengths); a null element is NaN, a null list is empty."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lengths


def _summed(batch: pa.RecordBatch, totals: Totals) -> None:
    """Rows of a batch by key; halves of it where their lengths differ much."""
    x, lengths = _flat(batch.column("vec"))
    codes = batch.column("key").dictionary_encode(null_encoding="encode")
    names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if batch.num_rows > 1 and len(names) * width > 4 * max(len(x), 1024):
        half = batch.num_rows // 2
        _summed(batch.slice(0, half), totals)
        _summed(batch.slice(half), totals)
        return
    ends = np.cumsum(lengths)
    cell = np.repeat(code.astype(np.int64) * width - (ends - lengths), lengths) + np.arange(len(x))
    there = ~np.isnan(x)
    shape = len(names), width
    sums = np.bincount(cell[there], x[there], len(names) * width).astype(np.float64).reshape(shape)
    counts = np.bincount(cell[there], minlength=len(names) * width).reshape(shape)
    longest = np.zeros(len(names), np.int64)
    np.maximum.at(longest, code, lengths)
    for k, name in enumerate(names):
        totals.add(name, sums[k, :longest[k]].copy(), counts[k, :longest[k]].copy())


def vector_sums(df: DataFrame, key: str, vector: Column) -> DataFrame:
    """``key, sums, counts`` for each value of a column: at each position the sum and the
    number of elements that are neither null nor NaN.

    Each task adds up its rows in arrays, so what is shuffled is one row for each key and
    task, and these are added one by one. A null array counts as empty, arrays of one key
    may differ in length; null and NaN are keys like any other. A key without an element
    has empty arrays. No rows give no rows.
    """
    kind = df.schema[key].dataType
    value = F.col(key)
    if kind.typeName() in ("float", "double"):  # one zero and one NaN, also when shuffled
        value = F.when(F.isnan(value), F.lit(float("nan")).cast(kind)).otherwise(value + F.lit(0).cast(kind))
    rows = df.select(value.alias("key"), vector.cast("array<double>").alias("vec"))
    schema = f"key {kind.simpleString()}, sums array<double>, counts array<bigint>"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, of = Totals(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.schema.field("key").type
            _summed(batch, totals)
            if totals.cells > CELLS:
                yield totals.drain(of)
        if totals.held:
            yield totals.drain(of)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, of = Totals(), None
        for batch in batches:
            of = batch.schema.field("key").type
            for k, s, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                # sorted by key: all before another key is complete
                if totals.cells > CELLS and not totals.has(k):
                    yield totals.drain(of)
                totals.add(k, np.array(s, np.float64), np.array(c, np.int64))
        if totals.held:
            yield totals.drain(of)

    dealt = rows.mapInArrow(gather, schema).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(merge, schema).withColumnRenamed("key", key)


def element_moments(df: DataFrame, vector: Column) -> DataFrame:
    """``mean, std`` (population) over all elements of all rows that are neither null nor
    NaN, from one row of count, mean and squares a batch; both null without an element."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, squares = 0, 0.0, 0.0
        for batch in batches:
            x, _ = _flat(batch.column("vec"))
            x = x[~np.isnan(x)]
            if len(x):
                middle = float(x.mean())
                gap, both = middle - mean, n + len(x)
                squares += float(((x - middle) ** 2).sum()) + gap * gap * n * len(x) / both
                mean += gap * len(x) / both
                n = both
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "mean": [mean], "squares": [squares]})

    parts = df.select(vector.cast("array<double>").alias("vec")).mapInArrow(
        moments, "n bigint, mean double, squares double"
    )
    n = F.sum("n")
    whole = F.sum(F.col("n") * F.col("mean")) / n
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) / n - whole * whole
    spread = F.sum("squares") / n + F.greatest(between, F.lit(0.0))
    return parts.agg(whole.alias("mean"), F.sqrt(spread).alias("std"))

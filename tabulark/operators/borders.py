"""Sequences of sessions in even parts: one sorted pass over each, borders carried over.

The rows of a session are cut into parts of counted rows: a histogram of (session, time
bucket) is part of the plan, so parts follow from the data alone, a session with very many
rows is as many parts as it needs, and nothing runs while the plan is made. A part is
read in order in batches of bounded size, so even rows that share a bucket (or a time)
only make a part long, never large in memory.

What crosses a border is small: each batch gives one row that tells how it changes the
state of its session; these rows, one after the other, give the state that each part
begins with, and a second pass over the same shuffled rows starts from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulark.operators.ordered import micros

PART_ROWS, BUCKET_SECONDS = 500_000, 60.0
PART = "part"


def with_parts(
    df: DataFrame, rows: int = PART_ROWS, bucket_seconds: float = BUCKET_SECONDS
) -> DataFrame:
    """Add ``at`` (microseconds) and ``part`` (session, number), dealt out by part. A part
    has at most ``rows`` rows and those of one time bucket more. A null session is one, too."""
    timed = df.withColumn("at", micros(F.col("ts")))
    bucket = F.floor(F.col("at") / int(bucket_seconds * 1_000_000))
    unit = F.struct(F.col("sid"), bucket.alias("bucket"))
    counts = timed.groupBy("sid", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / rows)
    units = counts.select(F.struct("sid", "bucket").alias("of_unit"), number.alias("number"))
    placed = timed.withColumn("unit", unit).join(units, F.col("unit") == F.col("of_unit"))
    return placed.withColumn(PART, F.struct("sid", "number")).select(*timed.columns, PART).repartition(PART)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Stretches of rows of one part, and whether a part begins with them."""
    import pyarrow.compute as pc

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(PART)
        sid, number = part.field(0), part.field(1)
        edges = [0]
        if batch.num_rows > 1:
            one, two = sid.slice(0, len(sid) - 1), sid.slice(1)
            same = pc.or_kleene(pc.equal(one, two), pc.and_(pc.is_null(one), pc.is_null(two)))
            same = pc.and_(pc.fill_null(same, False),
                           pc.equal(number.slice(0, len(sid) - 1), number.slice(1)))
            edges += (pc.indices_nonzero(pc.invert(same)).to_numpy() + 1).tolist()
        for start, end in zip(edges, [*edges[1:], batch.num_rows]):
            key = sid[start].as_py(), number[start].as_py()
            yield key != last, batch.slice(start, end - start)
            last = key


def fields(schema: str) -> dict[str, pa.DataType]:
    """Names and Arrow types of ``name type, ...``."""
    of = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return {name: of[kind] for name, kind in (f.split() for f in schema.split(","))}


def carried_states(
    summaries: DataFrame, start: dict, step: Callable[[dict, dict], dict], schema: str
) -> DataFrame:
    """The state with which each part begins: ``of_part`` and the fields of ``schema``, from
    one row ``part, piece, ...`` for each batch of each part. ``step`` gives the state after."""
    kinds = fields(schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = state = None
        first = True
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sid = row[PART]["sid"]
                if first or sid != last:
                    last, state, first = sid, dict(start), False
                if row["piece"] == 0:
                    out.append({"of_part": row[PART], **state})
                state = step(state, row)
            arrays = [pa.array([r["of_part"] for r in out], batch.schema.field(PART).type)]
            arrays += [pa.array([r[c] for r in out], kind) for c, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays(arrays, ["of_part", *kinds])

    kind = summaries.schema[PART].dataType.simpleString()
    dealt = summaries.withColumn("sid", F.col(f"{PART}.sid")).repartition("sid")
    ordered = dealt.sortWithinPartitions("sid", F.col(f"{PART}.number"), "piece")
    return ordered.mapInArrow(fold, f"of_part {kind}, {schema}")

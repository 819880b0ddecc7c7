"""Running values over very long sequences.

A window over a whole session would put a hot session into one task. Here a
session is cut into chunks (stretches of its own order) and windows run inside a
chunk, so a hot session spreads over as many tasks as it has chunks. The last row
of a chunk then knows what the chunk passes on; those rows form a table with one
row per chunk, from which every chunk learns what lies before it, joined on
(session, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK = "chunk"


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp; one without zone is read in the session zone."""
    return F.unix_micros(ts.cast("timestamp"))


def sequence_chunk(seq: Column, rows: int) -> Column:
    """Chunk number of a unique sequence number; at most ``rows`` rows per session."""
    return F.floor(seq / rows)


class Chunks:
    """Windows of a chunked sequence: ``keys`` name the session, ``order`` the rows."""

    def __init__(self, keys: Sequence[str], order: Sequence[str]):
        self.keys = list(keys)
        self.order = list(order)

    def rows(self, end: int = Window.currentRow) -> WindowSpec:
        return (
            Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order)
            .rowsBetween(Window.unboundedPreceding, end)
        )

    def lag_rows(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order)

    def earlier(self) -> WindowSpec:
        return (
            Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        )

    def is_tail(self) -> Column:
        """True on the last row of a chunk."""
        return F.lead(F.lit(1)).over(self.lag_rows()).isNull()

    def attach(self, df: DataFrame, per_chunk: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Bring per-chunk values to the rows of the chunk; a null session is one, too."""
        names = [*self.keys, CHUNK]
        side = per_chunk.select(*[F.col(c).alias(f"_of_{c}") for c in names], *columns)
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in names]
        return df.join(side, same).drop(*[f"_of_{c}" for c in names])

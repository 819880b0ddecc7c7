"""Exact percentiles that do not gather a column in one place.

Small columns use Spark's exact ``percentile`` in one aggregation. For larger
ones each wanted rank is enclosed by two mergeable approximate percentiles,
counted exactly, and enclosed again inside that bracket until few rows are left.
A round is two aggregations for all columns and ranks together and leaves about
1/500 of the rows in question.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATHER_ROWS = 1_000_000
BRACKET = 0.001
ACCURACY = 10_000


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN read as missing."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value


@dataclass
class _Search:
    """One wanted rank: the open interval it lies in and the rows of that interval."""

    column: str
    rank: int  # 0-based, inside the interval
    rows: int
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def inside(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > self.low)
        if self.high is not None:
            test = test & (value < self.high)
        return test

    def narrow(self, ends: list[float], n: dict[str, int]) -> None:
        low, high = ends
        steps = [
            ("under", lambda: self._move(self.low, low, n["under"])),
            ("at_low", lambda: self._found(low)),
            ("between", lambda: self._move(low, high, n["between"])),
            ("at_high", lambda: self._found(high)),
        ]
        for name, hit in steps:
            if self.rank < n[name]:
                return hit()
            self.rank -= n[name]
        self._move(high, self.high, self.rows - sum(n.values()))

    def _move(self, low: float | None, high: float | None, rows: int) -> None:
        self.low, self.high, self.rows = low, high, rows

    def _found(self, value: float) -> None:
        self.answer = value


def _search_ranks(
    df: DataFrame, values: Mapping[str, Column], searches: list[_Search], gather: int
) -> None:
    """Find the value of every search; each round serves all columns and ranks."""
    while wide := [s for s in searches if s.answer is None and s.rows > gather]:
        brackets = []
        for i, s in enumerate(wide):
            share = (s.rank + 0.5) / s.rows
            ends = F.array(
                F.lit(max(0.0, share - BRACKET)), F.lit(min(1.0, share + BRACKET))
            )
            v = values[s.column]
            brackets.append(
                F.percentile_approx(F.when(s.inside(v), v), ends, F.lit(ACCURACY)).alias(f"e{i}")
            )
        found = df.agg(*brackets).first()
        counts = []
        for i, s in enumerate(wide):
            (low, high), v = found[f"e{i}"], values[s.column]
            inside = s.inside(v)
            counts += [
                F.count_if(inside & (v < low)).alias(f"under{i}"),
                F.count_if(inside & (v == low)).alias(f"at_low{i}"),
                F.count_if(inside & (v > low) & (v < high)).alias(f"between{i}"),
                F.count_if(inside & (v == high) & (v > low)).alias(f"at_high{i}"),
            ]
        n = df.agg(*counts).first()
        for i, s in enumerate(wide):
            s.narrow(
                list(found[f"e{i}"]),
                {k: n[f"{k}{i}"] for k in ("under", "at_low", "between", "at_high")},
            )
    rest = [s for s in searches if s.answer is None]
    if rest:
        kept = df.select(
            *[F.when(s.inside(values[s.column]), values[s.column]).alias(f"v{i}")
              for i, s in enumerate(rest)]
        )
        row = kept.agg(
            *[F.expr(f"percentile_disc({(s.rank + 0.5) / s.rows!r}D) WITHIN GROUP (ORDER BY v{i})")
              .alias(f"p{i}") for i, s in enumerate(rest)]
        ).first()
        for i, s in enumerate(rest):
            s.answer = row[f"p{i}"]


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    gather: int = GATHER_ROWS,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Interpolated percentiles per column, nulls and NaN skipped. ``counts`` are
    the numbers of present values, when already known."""
    columns = list(columns)
    values = {c: present(df, c) for c in columns}
    if counts is None:
        counts = df.agg(*[F.count(values[c]).alias(c) for c in columns]).first().asDict()
    out: dict[str, list[float | None]] = {}

    direct = [c for c in columns if counts[c] <= gather]
    if direct:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        row = df.agg(
            *[F.percentile(values[c].cast("double"), wanted).alias(c) for c in direct]
        ).first()
        for c in direct:
            out[c] = list(row[c]) if row[c] is not None else [None] * len(probabilities)

    large = [c for c in columns if c not in out]
    doubles = {c: values[c].cast("double") for c in large}
    searches = {
        (c, rank): _Search(c, rank, counts[c])
        for c in large
        for p in probabilities
        for rank in (math.floor(p * (counts[c] - 1)), math.ceil(p * (counts[c] - 1)))
    }
    if searches:
        _search_ranks(df, doubles, list(searches.values()), gather)
    for c in large:
        out[c] = []
        for p in probabilities:
            place = p * (counts[c] - 1)
            low = searches[c, math.floor(place)].answer
            high = searches[c, math.ceil(place)].answer
            # the arithmetic of Spark's own percentile, to the last digit
            out[c].append(
                low if low == high
                else (math.ceil(place) - place) * low + (place - math.floor(place)) * high
            )
    return out

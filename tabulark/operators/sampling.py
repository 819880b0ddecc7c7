"""Ordering, sampling and splitting without a window over a whole table or class.

Random order is the order of an MD5 of (seed, id): repeatable, independent of
partitioning, and evenly spread, so a fixed prefix of the digest cuts even a
class that holds most of the table into equal, ordered pieces.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tabulark import constants as K

PREFIX_DIGITS = 3
GROUP_SLICES = 256


def seeded_hash(seed: int, *parts: Column) -> Column:
    texts = [p.cast("string") for p in parts]
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *texts))


def head_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(score), tie).limit(k)


def sort_by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key)


def sort_by_value(df: DataFrame, value: str, key: str) -> DataFrame:
    return df.orderBy(value, key)


def first_per_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """The first row of each group; partly reduced before the shuffle."""
    row = F.struct(*[F.col(c) for c in df.columns])
    picked = df.groupBy(F.col(group).alias("_group")).agg(F.min_by(row, F.col(order)).alias("_row"))
    return picked.select("_row.*")


def first_n_per_group(df: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each group: of the first n of each even slice of a group, so
    that no task sorts a hot group."""
    slice_of = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(GROUP_SLICES))
    inner = Window.partitionBy(group, "_slice").orderBy(*order)
    final = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_slice", slice_of)
        .withColumn("_rank", F.row_number().over(inner))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(final))
        .where(F.col("_rank") <= n)
        .drop("_slice", "_rank")
    )


def shuffled_position(
    df: DataFrame,
    id_column: str,
    seed: int,
    strata: str | None = None,
    position: str = "position",
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """0-based place of each row in the seeded random order (of its stratum).

    Rows are numbered inside (stratum, digest prefix) only; the sizes of the
    earlier prefixes come from a count that is reduced before its shuffle.
    """
    stratum = F.col(strata) if strata else F.lit(0)
    keyed = df.withColumns(
        {"_s": stratum, "_h": seeded_hash(seed, F.col(id_column))}
    ).withColumn("_p", F.substring("_h", 1, digits))
    sizes = keyed.groupBy("_s", "_p").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        F.col("_s").alias("_s2"), F.col("_p").alias("_p2"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("_s", "_p").orderBy("_h", id_column)
    return (
        keyed.withColumn("_local", F.row_number().over(inside) - 1)
        .join(before, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_p") == F.col("_p2")))
        .withColumn(position, F.col("_before") + F.col("_local"))
        .drop("_s", "_h", "_p", "_s2", "_p2", "_before", "_local")
    )


def sample_n(df: DataFrame, n: int, id_column: str, seed: int) -> DataFrame:
    """Exactly n rows without replacement, the first n in seeded random order; an error
    when the table has fewer. A threshold on the hash leaves little more than n rows to
    sort: n and eight deviations of the number that falls below it, and more if need be."""
    have = df.count()
    if have < n:
        raise ValueError(f"cannot take {n} rows from a table of {have}")
    hashed = seeded_hash(seed, F.col(id_column))
    number = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")
    wanted = n + 8 * n**0.5 + 64
    while True:
        below = df.where(number < int(wanted / have * 2**32) + 1) if wanted < have else df
        if wanted >= have or below.count() >= n:
            return below.orderBy(hashed, id_column).limit(n)
        wanted *= 2


def sample_one_per_key(df: DataFrame, key: str, id_column: str, seed: int) -> DataFrame:
    """One random row of each key; partly reduced before the shuffle."""
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(seeded_hash(seed, F.col(key), F.col(id_column)), F.col(id_column))
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, order).alias("_row")).select("_row.*")


def _class_sizes(df: DataFrame, label: str) -> tuple[DataFrame, Row]:
    """Rows per class (``label``, ``_n``), and one row about all of them: ``classes``,
    ``rows``, ``least``, ``most``."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(label).isNotNull()
    facts = sizes.agg(
        F.count_if(~known).alias("gaps"), F.count_if(known).alias("classes"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.min("_n"), F.lit(0)).alias("least"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("most"),
    ).first()
    if facts["gaps"]:
        raise ValueError(f"{label} has missing values")
    return sizes, facts


def stratified_kfold(
    df: DataFrame, label: str, id_column: str, k: int = K.FOLDS, seed: int = K.SEED, fold: str = "fold"
) -> DataFrame:
    """Fold number per row: classes laid end to end in shuffled order and dealt
    round robin, so fold sizes and class counts differ by at most one."""
    sizes, facts = _class_sizes(df, label)
    if k > facts["most"]:
        raise ValueError(f"{k} folds need a class of at least {k} rows")
    # one row per class passes through this window
    earlier = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(label, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    placed = shuffled_position(df, id_column, seed, strata=label, position="_place")
    return (
        placed.join(starts, label)
        .withColumn(fold, ((F.col("_start") + F.col("_place")) % k).cast("int"))
        .select(*df.columns, fold)
    )


def class_quotas(sizes: DataFrame, label: str, rows: int, wanted: int) -> DataFrame:
    """``label``, ``_quota``: rows per class for a held-out share of ``wanted`` of all
    ``rows``, proportional and rounded by largest remainder (ties: smaller label)."""
    exact = F.col("_n") * F.lit(wanted) / F.lit(rows)
    parts = sizes.select(label, F.floor(exact).alias("_floor"), (exact - F.floor(exact)).alias("_rest"))
    order = Window.orderBy(F.desc("_rest"), label)
    extra = F.lit(wanted) - F.sum("_floor").over(Window.partitionBy())
    more = (F.row_number().over(order) <= extra).cast("long")
    return parts.select(label, (F.col("_floor") + more).alias("_quota"))


def stratified_split(
    df: DataFrame,
    label: str,
    id_column: str,
    fraction: float = K.TEST_FRACTION,
    seed: int = 0,
    split: str = "split",
) -> DataFrame:
    """Mark each row as ``train`` or ``test`` with class-proportional quotas."""
    sizes, facts = _class_sizes(df, label)
    wanted = math.ceil(fraction * facts["rows"])
    if facts["least"] < 2:
        raise ValueError("every class needs at least two rows")
    if wanted < facts["classes"] or facts["rows"] - wanted < facts["classes"]:
        raise ValueError("both sides of the split need room for every class")
    placed = shuffled_position(df, id_column, seed, strata=label, position="_place")
    side = F.when(F.col("_place") < F.col("_quota"), F.lit("test")).otherwise(F.lit("train"))
    return (
        placed.join(class_quotas(sizes, label, facts["rows"], wanted), label)
        .withColumn(split, side)
        .select(*df.columns, split)
    )


def best_model(scores: DataFrame, order: Sequence[str], name: str, score: str) -> DataFrame:
    """Model with the highest score; equal scores go to the one listed first."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(name))
    return scores.orderBy(F.desc(score), place).limit(1)

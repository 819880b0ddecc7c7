"""Table profiling: shapes, missing values, rates, histograms, pixel checks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.functions.passenger import percent_round
from tabulark.functions.pixels import has_bad_pixel, present_pixels
from tabulark.operators.quantiles import exact_percentiles, present
from tabulark.operators.vector_sums import element_moments, vector_sums


_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def _per_column(wide: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """One-row table with a column per name into (column, value) rows."""
    return wide.unpivot([], list(columns), "column", value)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def schema_info(df: DataFrame) -> DataFrame:
    """Type and number of present values of every column."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    wide = df.agg(*[F.count(present(df, c)).alias(c) for c in df.columns])
    return _per_column(wide, df.columns, "non_null").withColumn("dtype", types[F.col("column")])


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column."""
    columns = list(columns)
    fields = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    moments = df.agg(
        *[
            fn(present(df, c)).cast("double").alias(f"{c}|{name}")
            for c in columns
            for name, fn in fields.items()
        ]
    ).first()
    counts = {c: int(moments[f"{c}|count"]) for c in columns}
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75], counts=counts)
    rows = [
        (
            c, counts[c], moments[f"{c}|mean"], moments[f"{c}|std"],
            moments[f"{c}|min"], *quartiles[c], moments[f"{c}|max"],
        )
        for c in columns
    ]
    schema = (
        "column string, count long, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def missing_profile(df: DataFrame, digits: int = 1) -> DataFrame:
    """Columns with missing values, how many, and their share of the rows."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(present(df, c).isNull()).alias(c) for c in df.columns],
    )
    long = wide.unpivot(["n_rows"], df.columns, "column", "missing")
    return long.where("missing > 0").select(
        "column", "missing",
        percent_round(F.col("missing") / F.col("n_rows"), digits).alias("percent"),
    )


def missing_total(df: DataFrame) -> DataFrame:
    wide = df.agg(*[F.count_if(present(df, c).isNull()).alias(c) for c in df.columns])
    total = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0))
    return wide.select(total.cast("long").alias("missing"))


def target_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(present(df, label)).alias("rate"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    counted = df.where(present(df, column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.orderBy(F.desc("count"), column)


def group_rate(df: DataFrame, columns: Sequence[str], label: str, digits: int = 1) -> DataFrame:
    """Label rate in percent per value of each column, all columns in one job."""
    texts = [present(df, c).cast("string").alias(c) for c in columns]
    long = df.select(present(df, label).alias("_label"), *texts).unpivot(
        ["_label"], list(columns), "column", "value"
    )
    return (
        long.where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(percent_round(F.avg("_label"), digits).alias("rate"))
    )


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(present(df, column)).alias("n_distinct"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def range_check(df: DataFrame, label: str, pixels: str) -> DataFrame:
    """Smallest and largest label, and smallest and largest pixel of the table."""
    known, cells = present(df, label), present_pixels(F.col(pixels))
    return df.agg(
        F.min(known).alias("label_min"),
        F.max(known).alias("label_max"),
        F.min(F.array_min(cells)).alias("pixel_min"),
        F.max(F.array_max(cells)).alias("pixel_max"),
    )


def _row_digest(df: DataFrame) -> list[Column]:
    """128 bits of a row of plain values. Two chains of hashes with different beginnings;
    which values are null goes in first, since a hash passes over a null."""
    gaps = F.concat(F.lit(""), *[F.isnull(c).cast("int").cast("string") for c in df.columns])
    return [F.xxhash64(F.lit(k), gaps, *df.columns).alias(f"_digest{k}") for k in (1, 2)]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical row; nulls equal each other, as do NaNs.
    Rows of plain columns are told apart by 128-bit digests, so the shuffle does not grow
    with their width; rows with nested columns by their values."""
    plain = all(not isinstance(f.dataType, _NESTED) for f in df.schema)
    rows = df.select(*_row_digest(df)) if plain else df
    copies = rows.groupBy(*rows.columns).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))


def bad_label_count(df: DataFrame, label: str, classes: int) -> DataFrame:
    known = present(df, label)
    return df.agg(F.count_if((known < 0) | (known >= classes)).alias("bad_labels"))


def bad_pixel_rows(df: DataFrame, pixels: str) -> DataFrame:
    return df.agg(F.count_if(has_bad_pixel(F.col(pixels))).alias("bad_pixel_rows"))


def clean_removed(df: DataFrame, clean) -> DataFrame:
    """Rows before and after ``clean``, in one query; the count before needs no
    column, so a columnar source answers it from its footers."""
    n = F.count(F.lit(1))
    counted = clean(df).agg(n.alias("after")).withColumn("before", df.agg(n).scalar())
    return counted.select("before", "after", (F.col("before") - F.col("after")).alias("removed"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    sizes = df.where(present(df, label).isNotNull()).groupBy(label).count()
    return sizes.agg(
        F.min("count").alias("smallest"),
        F.max("count").alias("largest"),
        (F.max("count") / F.min("count")).alias("ratio"),
    )


def class_mean_image(df: DataFrame, label: str, pixels: str) -> DataFrame:
    """Average image per label; a position without a pixel is null, a label without any
    pixel has no row. Tasks add up whole images, so the shuffle holds one row for each
    label and task."""
    sums = vector_sums(df, label, F.col(pixels)).where(F.size("sums") > 0)
    mean = F.transform(
        F.arrays_zip("sums", "counts"), lambda s: F.try_divide(s["sums"], s["counts"])
    )
    return sums.select(label, mean.alias("mean_image"))


def class_brightness(df: DataFrame, label: str, pixels: str) -> DataFrame:
    """Average over the positions of a label's average image."""
    images = class_mean_image(df, label, pixels)
    seen = F.filter("mean_image", lambda m: m.isNotNull())
    total = F.aggregate(seen, F.lit(0.0), lambda a, m: a + m)
    return images.select(label, F.try_divide(total, F.size(seen)).alias("brightness"))


def pixel_moments(df: DataFrame, pixels: str) -> DataFrame:
    """Mean and population deviation of all pixels that are there."""
    return element_moments(df, F.col(pixels))


def histogram_equal(
    df: DataFrame, value: str, bins: int, by: str | None = None
) -> DataFrame:
    """Equal-width bins between the smallest and largest value (per ``by`` group),
    the last bin closed, empty bins kept, missing values left out."""
    x = present(df, value).cast("double")
    group = F.col(by) if by else F.lit(0)
    name = by or "_all"
    rows = df.select(group.alias(name), x.alias("x")).where("x IS NOT NULL")
    ends = rows.groupBy(name).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.col(name).alias("_of"),
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * step)

    guess = F.least(
        F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)
    ).cast("int")
    placed = rows.join(ends, F.col(name).eqNullSafe(F.col("_of"))).select(
        name, "x", "lo", "hi", guess.alias("guess")
    )
    g = F.col("guess")
    index = (
        F.when((F.col("x") < edge(g)) & (g > 0), g - 1)
        .when((F.col("x") >= edge(g + 1)) & (g < bins - 1), g + 1)
        .otherwise(g)
    )
    counts = placed.groupBy(name, index.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    empty = ends.select(
        F.col("_of").alias(name), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.lit(0).alias("count")
    )
    filled = counts.unionByName(empty).groupBy(name, "bin").agg(F.sum("count").alias("count"))
    out = filled.join(ends, F.col(name).eqNullSafe(F.col("_of"))).select(
        name, "bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"),
        "count",
    )
    return out if by else out.drop(name)


def nice_width(low: float, high: float, max_bins: int) -> float:
    """Smallest of 1, 2, 5 times a power of ten that needs at most ``max_bins`` bins."""
    span = (high - low) or abs(low) or 1.0
    power = math.floor(math.log10(span / max_bins))
    for k in (power - 1, power, power + 1):
        for digit in (1, 2, 5):
            width = digit * 10.0**k if k >= 0 else digit / 10.0**-k
            if span / width <= max_bins:
                return width
    return 10.0 ** (power + 2)


def histogram_nice(df: DataFrame, value: str, by: Column, max_bins: int = 30) -> DataFrame:
    """Rows per outcome and round-width bin."""
    x = present(df, value).cast("double")
    rows = df.select(by.alias("outcome"), x.alias("x")).where("x IS NOT NULL")
    ends = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if ends["lo"] is None:
        width = 1.0
    else:
        width = nice_width(ends["lo"], ends["hi"], max_bins)
    low = F.floor(F.col("x") / width) * width
    return (
        rows.groupBy("outcome", low.alias("low"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("high", F.col("low") + width)
    )


def yield_per_class(df: DataFrame, label: str, found: Column) -> DataFrame:
    """Rows kept and rows looked at, per class."""
    return df.groupBy(label).agg(
        F.count_if(found).alias("kept"), F.count(F.lit(1)).alias("scanned")
    )


def score_summary(scores: DataFrame, by: str, score: str) -> DataFrame:
    """Mean and population deviation of the fold scores of each model."""
    return scores.groupBy(by).agg(
        F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score")
    )

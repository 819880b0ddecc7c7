"""Imputation, scaling and one-hot encoding, fitted by two aggregations.

The fitted result is a plain ``PipelineModel`` of stock Spark ML stages, so it is
saved, loaded and applied like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.operators.quantiles import exact_percentiles, present


def fit_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column, missing values skipped."""
    medians = exact_percentiles(df, columns, [0.5])
    return df.sparkSession.createDataFrame(
        [(c, medians[c][0]) for c in columns], "column string, median double"
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) over all columns in one shuffle, missing left out."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return long.where("value IS NOT NULL").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("count")
    )


def fit_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column; equal counts go to the smallest value."""
    best = F.min(F.struct((-F.col("count")).alias("negated"), "value"))
    return category_counts(df, columns).groupBy("column").agg(best["value"].alias("mode"))


def fit_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, missing values skipped."""
    wide = df.agg(
        *[F.avg(present(df, c).cast("double")).alias(f"{c}|mean") for c in columns],
        *[F.stddev_pop(present(df, c).cast("double")).alias(f"{c}|std") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}|mean`").alias("mean"),
                     F.col(f"`{c}|std`").alias("std"))
            for c in columns
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def _vocabulary(df: DataFrame, columns: Sequence[str]) -> dict[str, list[tuple[str, int]]]:
    """Sorted (category, rows) pairs per column, for the encoder that holds them anyway."""
    found: dict[str, list] = {c: [] for c in columns}
    for r in category_counts(df, columns).toLocalIterator():
        found[r["column"]].append((r["value"], r["count"]))
    return {c: sorted(pairs) for c, pairs in found.items()}


def fit_vocab(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categories of each column with their place in sorted order."""
    place = F.row_number().over(Window.partitionBy("column").orderBy("value")) - 1
    return category_counts(df, columns).select("column", "value", place.alias("place"))


def _numeric_plan(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """(fill, mean, deviation) per column. Scaling sees the imputed column, whose
    moments follow from those of the present values, their number and the fill."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        value = present(df, c).cast("double")
        aggregates += [
            F.count(value).alias(f"{c}|n"),
            F.avg(value).alias(f"{c}|mean"),
            F.var_pop(value).alias(f"{c}|var"),
        ]
    row = df.agg(*aggregates).first()
    medians = exact_percentiles(df, columns, [0.5], counts={c: row[f"{c}|n"] for c in columns})
    plan = {}
    for c in columns:
        fill = medians[c][0]
        if fill is None:
            raise ValueError(f"column {c} has no present value to fit on")
        share = row[f"{c}|n"] / row["rows"]
        mean = share * row[f"{c}|mean"] + (1 - share) * fill
        spread = share * (row[f"{c}|var"] + (row[f"{c}|mean"] - mean) ** 2)
        spread += (1 - share) * (fill - mean) ** 2
        deviation = math.sqrt(spread)
        plan[c] = (fill, mean, deviation if deviation > 0 else 1.0)
    return plan


class TabularPreprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric: median fill, then zero mean and unit population deviation.
    Categorical: most frequent fill, then one-hot over the sorted categories;
    a category not seen in the fit becomes all zeros."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    categoricalCols = Param(
        Params._dummy(), "categoricalCols", "categorical columns", TypeConverters.toListString
    )
    outputCol = Param(Params._dummy(), "outputCol", "feature vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(
            numericCols=K.NUMERIC_FEATURES, categoricalCols=K.CATEGORICAL_FEATURES,
            outputCol="features",
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric = self.getOrDefault("numericCols")
        categorical = self.getOrDefault("categoricalCols")
        expressions, stages = ["*"], []
        for c, (fill, mean, deviation) in _numeric_plan(dataset, numeric).items():
            value = f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {fill!r}D)"
            expressions.append(f"({value} - ({mean!r}D)) / {deviation!r}D AS `num__{c}`")

        vocabulary = _vocabulary(dataset, categorical) if categorical else {}
        for c, values in vocabulary.items():
            if not values:
                raise ValueError(f"column {c} has no present value to fit on")
            mode = min(values, key=lambda v: (-v[1], v[0]))[0].replace("\\", "\\\\").replace("'", "\\'")
            expressions.append(f"coalesce(CAST(`{c}` AS STRING), '{mode}') AS `fill__{c}`")
        stages.append(SQLTransformer(statement=f"SELECT {', '.join(expressions)} FROM __THIS__"))

        if categorical:
            indexers = PipelineModel([
                StringIndexerModel.from_labels(
                    [value for value, _ in vocabulary[c]],
                    inputCol=f"fill__{c}", outputCol=f"index__{c}", handleInvalid="keep",
                )
                for c in categorical
            ])
            encoder = OneHotEncoder(
                inputCols=[f"index__{c}" for c in categorical],
                outputCols=[f"cat__{c}" for c in categorical],
                handleInvalid="error", dropLast=True,
            )
            shaped = stages[0].transform(dataset.limit(0))
            stages += [indexers, encoder.fit(indexers.transform(shaped))]
        names = [f"num__{c}" for c in numeric] + [f"cat__{c}" for c in categorical]
        output = self.getOrDefault("outputCol")
        stages.append(VectorAssembler(inputCols=names, outputCol=output))
        scratch = [f"num__{c}" for c in numeric]
        scratch += [f"{p}__{c}" for p in ("fill", "index", "cat") for c in categorical]
        dropped = ", ".join(f"`{c}`" for c in scratch)
        stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({dropped}) FROM __THIS__"))
        return PipelineModel(stages)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Name of every slot of an assembled vector, from its column metadata."""
    groups = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in groups.values() for a in kind)
    return [name for _, name in slots]

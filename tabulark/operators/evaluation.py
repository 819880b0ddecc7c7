"""Confusion matrix, binary metrics and the classification report.

Everything starts from one aggregation of the scored rows into (actual,
predicted) counts; what follows works on that table. A row without an actual or
without a predicted label is not scored: it counts nowhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.operators.quantiles import present


def _ratio(part: Column, whole: Column) -> Column:
    """Division that gives 0 for an empty denominator."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Scored rows per (actual, predicted)."""
    pairs = df.select(
        present(df, actual).alias("actual"), present(df, predicted).alias("predicted")
    )
    return pairs.where("actual IS NOT NULL AND predicted IS NOT NULL").groupBy(
        "actual", "predicted"
    ).agg(F.count(F.lit(1)).alias("count"))


def confusion_wide(df: DataFrame, actual: str, predicted: str, labels: Sequence) -> DataFrame:
    """One row per listed actual label and one column per listed predicted label,
    zeros kept."""
    labels = list(labels)
    kind = df.schema[actual].dataType.simpleString()
    empty = df.sparkSession.createDataFrame(
        [(x, x, 0) for x in labels], f"actual {kind}, predicted {kind}, count long"
    )
    pairs = pair_counts(df, actual, predicted).unionByName(empty)
    wide = pairs.where(F.col("actual").isin(labels)).groupBy("actual").pivot(
        "predicted", labels
    ).agg(F.sum("count"))
    return wide.na.fill(0)


def confusion_long(
    wide: DataFrame, names: Mapping | None = None
) -> DataFrame:
    """Wide matrix into (actual, predicted, count) rows, optionally with names."""
    columns = [c for c in wide.columns if c != "actual"]
    long = wide.select(F.col("actual").cast("string").alias("actual"), *columns).unpivot(
        ["actual"], columns, "predicted", "count"
    )
    if names is None:
        return long
    mapping = {str(k): v for k, v in names.items()}
    return long.replace(mapping, subset=["actual", "predicted"])


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, labels: Sequence | None = None
) -> DataFrame:
    """(actual, predicted, count) for every pair of the labels that occur on either
    side, or of the listed ones, zeros kept."""
    pairs = pair_counts(df, actual, predicted)
    if labels is None:
        sides = F.explode(F.array("actual", "predicted"))
        known = pairs.select(sides.alias("label")).distinct()
    else:
        kind = df.schema[actual].dataType.simpleString()
        known = df.sparkSession.createDataFrame([(x,) for x in labels], f"label {kind}")
    # the matrix has a cell for each pair of labels, whatever the number of rows
    grid = known.select(F.col("label").alias("actual")).crossJoin(
        known.select(F.col("label").alias("predicted"))
    )
    return grid.join(pairs, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).alias("count")
    )


def binary_metrics(df: DataFrame, actual: str, predicted: str, positive=1) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class, in one pass."""
    a, p = F.col(actual) == positive, F.col(predicted) == positive
    scored = present(df, actual).isNotNull() & present(df, predicted).isNotNull()
    counts = df.where(scored).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(actual) == F.col(predicted)).alias("right"),
        F.count_if(a & p).alias("tp"),
        F.count_if(p).alias("called"),
        F.count_if(a).alias("real"),
    )
    precision = _ratio(F.col("tp"), F.col("called"))
    recall = _ratio(F.col("tp"), F.col("real"))
    return counts.select(
        _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def classification_report(
    df: DataFrame,
    actual: str,
    predicted: str,
    labels: Sequence | None = None,
    names: Mapping | None = None,
    digits: int = 3,
) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy and averages.

    With a subset of labels the accuracy row gives way to the micro average.
    """
    pairs = pair_counts(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(F.lit(0))
    roles = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), hit.alias("tp"),
                         F.col("count").alias("support"), F.lit(0).cast("long").alias("called")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("tp"),
                         F.lit(0).cast("long").alias("support"), F.col("count").alias("called")),
            )
        ).alias("r")
    ).select("r.*")
    whole = True
    if labels is not None:
        listed = [F.col(c).isin(list(labels)) for c in ("actual", "predicted")]
        whole = not pairs.where(~listed[0] | ~listed[1]).take(1)
        kind = df.schema[actual].dataType.simpleString()
        wanted = df.sparkSession.createDataFrame(
            [(x, 0, 0, 0) for x in labels], f"label {kind}, tp long, support long, called long"
        )
        roles = roles.where(F.col("label").isin(list(labels))).unionByName(wanted)
    per_class = roles.groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "called")]
    )
    precision = _ratio(F.col("tp"), F.col("called"))
    recall = _ratio(F.col("tp"), F.col("support"))
    rated = per_class.select(
        F.col("label").cast("string").alias("label"), "tp", "support", "called",
        precision.alias("precision"), recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )
    if names is not None:
        rated = rated.replace({str(k): v for k, v in names.items()}, subset=["label"])

    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    # rollup gives the class rows and, in the same pass, one total row.
    rolled = rated.rollup("label").agg(
        F.grouping("label").alias("is_total"),
        *[F.sum(c).alias(c) for c in ("tp", "support", "called")],
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )
    micro_p = _ratio(F.col("tp"), F.col("called"))
    micro_r = _ratio(F.col("tp"), F.col("support"))
    share = _ratio(F.col("tp"), F.col("support"))

    def entry(name, p: Column, r: Column, f: Column) -> Column:
        return F.struct(
            name.alias("class"), F.bround(p, digits).alias("precision"),
            F.bround(r, digits).alias("recall"), F.bround(f, digits).alias("f1"),
            F.col("support").alias("support"),
        )

    first = (
        entry(F.lit("accuracy"), share, share, share)
        if whole
        else entry(F.lit("micro avg"), micro_p, micro_r, _f1(micro_p, micro_r))
    )
    averages = [
        entry(F.lit(f"{kind} avg"), *[F.col(f"{kind}_{c}") for c in ("precision", "recall", "f1")])
        for kind in ("macro", "weighted")
    ]
    own = entry(F.col("label"), *[F.col(f"macro_{c}") for c in ("precision", "recall", "f1")])
    rows = F.when(F.col("is_total") == 1, F.array(first, *averages)).otherwise(F.array(own))
    return rolled.select(F.explode(rows).alias("r")).select("r.*")

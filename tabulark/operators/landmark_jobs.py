"""Landmark training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.landmarks import jitter_points, landmark_normalize
from tabulark.operators.cleaning import min_rows_guard
from tabulark.operators.sampling import stratified_split


def landmark_augment(
    df: DataFrame, id_column: str, points: str, copies: int = K.JITTER_COPIES,
    sigma: float = K.JITTER_SIGMA, seed: int = 0,
) -> DataFrame:
    """The original (copy 0) and ``copies`` jittered versions of each raw hand."""
    numbered = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies))))
    noisy = jitter_points(F.col(points), sigma, F.lit(seed), F.col(id_column), F.col("copy"))
    return numbered.withColumn(
        points, F.when(F.col("copy") == 0, F.col(points)).otherwise(noisy)
    )


def landmark_training_table(
    df: DataFrame, id_column: str, points: str, label: str, handedness: str,
    copies: int = K.JITTER_COPIES, sigma: float = K.JITTER_SIGMA, seed: int = 0,
) -> DataFrame:
    """Split raw hands first, jitter only the training side, normalise last, so no
    copy of a held-out hand is ever trained on."""
    parted = stratified_split(min_rows_guard(df), label, id_column, seed=seed)
    n = F.when(F.col("split") == "train", F.lit(copies)).otherwise(F.lit(0))
    numbered = parted.withColumn("copy", F.explode(F.sequence(F.lit(0), n)))
    noisy = jitter_points(F.col(points), sigma, F.lit(seed), F.col(id_column), F.col("copy"))
    raw = F.when(F.col("copy") == 0, F.col(points)).otherwise(noisy)
    hand = F.coalesce(F.col(handedness), F.lit("Right"))
    return numbered.select(
        id_column, label, "split", "copy", landmark_normalize(raw, hand).alias("features")
    )

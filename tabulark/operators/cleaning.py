"""Row cleaning and the pixel dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.pixels import has_missing_pixel, pixel_pack, pixel_reshape, pixel_scale



def dedup_rows(df: DataFrame) -> DataFrame:
    """One of each identical row, nulls equal. Copies are merged before the shuffle;
    rows are compared as one struct, which keeps the generated code small."""
    return df.select(F.struct(*df.columns).alias("_row")).distinct().select("_row.*")


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any of the columns (default: all)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def label_filter(df: DataFrame, label: str = "label", classes: int = K.LABEL_CLASSES) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("int")).where(
        (F.col(label) >= 0) & (F.col(label) < classes)
    )


def clean_table(df: DataFrame, label: str = "label", classes: int = K.LABEL_CLASSES) -> DataFrame:
    """Drop exact copies, then rows with gaps, then labels out of range."""
    return label_filter(drop_missing(dedup_rows(df)), label, classes)


def label_union(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Sorted labels that occur on either side; both are reduced before the shuffle."""
    both = df.select(F.explode(F.array(actual, predicted)).alias("label"))
    return both.where("label IS NOT NULL").distinct().orderBy("label")


def pixel_dataset(
    train: DataFrame, test: DataFrame, side: int = K.IMAGE_SIDE, normalize: bool = True,
    classes: int = K.LABEL_CLASSES,
) -> DataFrame:
    """Both given tables cleaned separately, as images with their split kept."""

    def prepared(df: DataFrame, split: str) -> DataFrame:
        # Packed first: everything after works on two columns, however many pixels.
        names = [c for c in df.columns if c != "label"]
        whole = dedup_rows(df.select("label", pixel_pack(names).alias("pixels"))).where(
            F.col("label").isNotNull() & ~has_missing_pixel(F.col("pixels"))
        )
        kept = label_filter(whole, classes=classes)
        values = pixel_scale(F.col("pixels")) if normalize else F.col("pixels")
        return kept.select(
            F.lit(split).alias("split"), "label", pixel_reshape(values, side).alias("image")
        )

    return prepared(train, "train").unionByName(prepared(test, "test"))


def min_rows_guard(df: DataFrame, rows: int = K.MIN_TRAINING_ROWS) -> DataFrame:
    """Refuse a training table with too few rows; reads no more than needed."""
    if df.limit(rows).count() < rows:
        raise ValueError(f"fewer than {rows} usable rows to train on")
    return df

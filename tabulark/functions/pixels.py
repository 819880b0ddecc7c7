"""Expressions over pixel arrays (row-major square images)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulark.functions.arrays import bind


def pixel_pack(columns: Sequence[str]) -> Column:
    """Numbered pixel columns into one array."""
    return F.array(*[F.col(c).cast("float") for c in columns])


def pixel_scale(pixels: Column) -> Column:
    """0..255 to 0..1 in single precision."""
    return F.transform(pixels, lambda p: (p.cast("float") / F.lit(255.0).cast("float")).cast("float"))


def pixel_reshape(pixels: Column, side: int) -> Column:
    """Flat pixels into rows of the image."""
    rows = F.sequence(F.lit(0), F.lit(side - 1))
    return bind(pixels, lambda p: F.transform(rows, lambda r: F.slice(p, r * side + 1, side)))


def pixel_flatten(image: Column) -> Column:
    return F.flatten(image)


def present_pixels(pixels: Column) -> Column:
    """The pixels that are neither null nor NaN."""
    return F.filter(pixels, lambda p: p.isNotNull() & ~F.isnan(p))


def has_bad_pixel(pixels: Column) -> Column:
    """Any pixel below 0 or above 255; missing pixels do not count."""
    return F.exists(
        pixels, lambda p: F.coalesce((p < 0) | ((p > 255) & ~F.isnan(p)), F.lit(False))
    )


def has_missing_pixel(pixels: Column) -> Column:
    """Any pixel null or not a number."""
    return F.exists(pixels, lambda p: p.isNull() | F.isnan(p))

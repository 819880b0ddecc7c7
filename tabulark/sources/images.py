"""Image folders: listing by letter, decoding, and sign assets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.operators.sampling import first_n_per_group


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def image_tree_scan(spark: SparkSession, root: str, per_class: int | None = None) -> DataFrame:
    """Image files of the single-letter sub-folders, by name, at most ``per_class``
    each. Only paths are read; file contents stay where they are."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    )
    listed = files.select(
        "path",
        _folder(F.col("path")).alias("folder"),
        _file_name(F.col("path")).alias("file"),
    )
    suffixes = "|".join(K.IMAGE_SUFFIXES)
    # Direct children of a letter folder only, as a folder listing gives them.
    base = re.sub(r"^[a-z0-9]+:/+", "/", root).rstrip("/")
    inside = F.split_part(F.col("path"), F.lit(base), F.lit(-1))
    kept = listed.where(
        F.col("folder").rlike(r"^\p{L}$")
        & F.lower("file").rlike(rf"\.({suffixes})$")
        & (F.size(F.split(inside, "/")) == 3)
    ).select(F.upper("folder").alias("letter"), "file", "path")
    if per_class is None:
        return kept
    return first_n_per_group(kept, "letter", ["file", "path"], per_class)


def image_decode(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images (bytes in blue, green, red order); unreadable files dropped."""
    images = (
        spark.read.format("image").option("dropInvalid", True)
        .option("recursiveFileLookup", True).load(root)
    )
    return images.select(
        F.col("image.origin").alias("path"), "image.height", "image.width", "image.nChannels",
        "image.data",
    )


def asset_lookup_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Letter (upper-cased file stem) and base64 content of each ``.jpg`` in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(folder)
    stem = F.regexp_extract("path", r"([^/]+)\.jpg$", 1)
    return files.select(F.upper(stem).alias("letter"), F.base64("content").alias("content"))

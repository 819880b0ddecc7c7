"""Dictionary lookups and character jobs as equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.letters import letter_to_label, letters_of, sign_kind
from tabulark.operators.sampling import seeded_hash, shuffled_position

SPREAD = 1_024  # join keys over which characters without a sample are dealt


def dim_lookup_join(
    df: DataFrame, dimension: DataFrame, key: str, value: str, default
) -> DataFrame:
    """Dictionary lookup with a default for keys the dictionary lacks."""
    side = dimension.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(value, F.coalesce("_value", F.lit(default))).drop("_key", "_value")


def letter_dimension(spark) -> DataFrame:
    """The fixed label dictionary as a table."""
    rows = list(enumerate(K.ALPHABET))
    return spark.createDataFrame(rows, "label int, letter string")


def text_to_sign_join(
    messages: DataFrame, text: str, assets: DataFrame, keep: Sequence[str], payload: str | None = None
) -> DataFrame:
    """One row per character of each message, in order, with how it is shown.

    ``assets`` has upper-case ``letter``s; the optional payload column (the smallest, if a
    letter has several) travels with the character.
    """
    letters = assets.where("letter IS NOT NULL").groupBy(F.col("letter").alias("_asset"))
    side = letters.agg(*([F.min(payload).alias(payload)] if payload else [F.lit(1).alias("_one")]))
    side = side.drop("_one")
    chars = messages.select(*keep, F.posexplode(letters_of(F.col(text))).alias("pos", "ch"))
    joined = chars.join(side, F.upper("ch") == F.col("_asset"), "left")
    return joined.withColumn("kind", sign_kind(F.col("ch"), F.col("_asset").isNotNull())).drop("_asset")


def _hash_index(size: Column, seed: int, *parts: Column) -> Column:
    """Repeatable number in 0..size-1."""
    head = F.conv(F.substring(seeded_hash(seed, *parts), 1, 8), 16, 10).cast("long")
    return head % size


def word_readback(
    words: DataFrame,
    samples: DataFrame,
    word_id: str,
    word: str,
    label: str,
    sample_id: str,
    read: str,
    seed: int = 0,
) -> DataFrame:
    """Spell each word with one random sample per letter and read it back.

    Samples are numbered inside their label and a letter picks a number, so the
    join meets exactly one sample per letter instead of every sample of a label.
    """
    numbered = shuffled_position(
        samples.select(label, sample_id, read), sample_id, seed, strata=label, position="_index"
    )
    sizes = samples.groupBy(F.col(label).alias("_wanted")).agg(F.count(F.lit(1)).alias("_size"))
    letters = words.select(
        word_id, word, F.posexplode(letters_of(F.upper(word))).alias("_pos", "_letter")
    ).withColumn("_wanted", letter_to_label(F.col("_letter")))
    # without a sample the number is one below 0 that no sample has
    nowhere = -1 - F.pmod(F.xxhash64(word_id, "_pos"), F.lit(SPREAD))
    drawn = letters.join(sizes, "_wanted", "left").withColumn(
        "_index",
        F.coalesce(_hash_index(F.col("_size"), seed, F.col(word_id), F.col("_pos")), nowhere),
    )
    pool = numbered.select(F.col(label).alias("_wanted"), "_index", F.col(read).alias("_read"))
    met = drawn.join(pool, ["_wanted", "_index"], "left").withColumn(
        "_read", F.coalesce("_read", F.lit(K.UNKNOWN_LETTER))
    )
    pieces = F.array_sort(F.collect_list(F.struct("_pos", "_read", "_letter")))
    return (
        met.groupBy(word_id, word)
        .agg(pieces.alias("_p"))
        .select(
            word_id,
            F.upper(word).alias("word"),
            F.array_join(F.transform("_p", lambda p: p["_read"]), "").alias("recognized"),
            F.size(F.filter("_p", lambda p: p["_read"] == p["_letter"])).alias("right_letters"),
        )
        .withColumn("is_match", F.col("recognized") == F.col("word"))
    )

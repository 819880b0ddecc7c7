"""Column expressions and transforms for the passenger table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K


def strip_blanks(text: Column) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def title_extract(name: Column) -> Column:
    """Text between the first comma and the next full stop; null without one."""
    # A match is never empty, so the empty result of a miss can be told apart.
    found = F.regexp_extract(name, "(?U)" + K.TITLE_PATTERN, 1)
    return strip_blanks(F.nullif(found, F.lit("")))


def title_group(title: Column) -> Column:
    """Fold rare titles together and map foreign forms; null stays null."""
    folded = F.when(title.isin(K.RARE_TITLES), F.lit("Rare"))
    for form, target in K.TITLE_SYNONYMS.items():
        folded = folded.when(title == form, F.lit(target))
    return folded.otherwise(title)


def family_size(sibsp: Column, parch: Column) -> Column:
    return sibsp + parch + 1


def is_alone(size: Column) -> Column:
    """1 for a family of one; an unknown size counts as 0."""
    return size.eqNullSafe(F.lit(1)).cast("int")


def deck_letter(cabin: Column) -> Column:
    first = F.substring(cabin, 1, 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.lit(K.UNKNOWN_DECK))


def has_value_flag(value: Column) -> Column:
    return value.isNotNull().cast("int")


def engineer_features(df: DataFrame) -> DataFrame:
    """Add Title, FamilySize, IsAlone, Deck and HasCabin."""
    size = family_size(F.col("SibSp"), F.col("Parch"))
    # The title is extracted in a projection of its own, hence once per row.
    return df.withColumn("Title", title_extract(F.col("Name"))).withColumns(
        {
            "Title": title_group(F.col("Title")),
            "FamilySize": size,
            "IsAlone": is_alone(size),
            "Deck": deck_letter(F.col("Cabin")),
            "HasCabin": has_value_flag(F.col("Cabin")),
        }
    )


def feature_select(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The model's columns in their fixed order, after any named extras."""
    return df.select(*extra, *K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES)


def value_map(value: Column, names: Mapping) -> Column:
    """Replace by dictionary; values outside it become null."""
    out = F.lit(None).cast("string")
    for key, text in names.items():
        out = F.when(value == F.lit(key), F.lit(text)).otherwise(out)
    return out


def strip_prefix(feature: Column) -> Column:
    """Feature name without the block it came from."""
    return F.regexp_replace(feature, "num__|cat__", "")


def percent_round(rate: Column, digits: int = 1) -> Column:
    """Rate as a percentage, ties to the even digit."""
    return F.bround(rate * 100, digits)

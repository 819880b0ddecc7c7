"""Letter, label and text expressions for fingerspelling tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.passenger import strip_blanks

ALPHABETIC = r"^\p{L}+$"


def label_to_letter(label: Column) -> Column:
    """0 -> A, 1 -> B ...; unknown labels give a question mark."""
    whole = label.cast("int")
    known = whole.between(0, len(K.ALPHABET) - 1)
    letter = F.substr(F.lit(K.ALPHABET), whole + 1, F.lit(1))
    return F.when(known, letter).otherwise(F.lit(K.UNKNOWN_LETTER))


def letter_to_label(letter: Column) -> Column:
    """A -> 0, B -> 1 ...; anything that is not one capital letter gives -1."""
    position = F.instr(F.lit(K.ALPHABET), letter)
    known = (F.length(letter) == 1) & (position > 0)
    return F.when(known, position - 1).otherwise(F.lit(K.UNKNOWN_LABEL))


def normalize_label(text: Column) -> Column:
    """Turn a classifier's label text into one letter."""
    bare = strip_blanks(text)
    lower = F.lower(bare)
    first = F.regexp_extract(bare, r"\p{L}", 0)
    return (
        F.when(lower.isin(K.SPACE_LABELS), F.lit(" "))
        .when(lower.isin(K.NO_LETTER_LABELS) | F.coalesce(first == "", F.lit(True)),
              F.lit(K.UNKNOWN_LETTER))
        .otherwise(F.upper(first))
    )


def letters_of(text: Column) -> Column:
    """The characters of a text, in order; no entry for the empty text."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def word_bad_letters(word: Column) -> Column:
    """Characters of the upper-cased word that have no static sign, in order."""
    static = [c for c in K.ALPHABET if c not in K.MOTION_LETTERS]
    return F.filter(letters_of(F.upper(word)), lambda c: ~c.isin(static))


def nonblank_text(text: Column) -> Column:
    """Stripped text, or null when nothing is left to use."""
    return F.nullif(strip_blanks(text), F.lit(""))


def text_edit(text: Column, action: Column, char: Column) -> Column:
    """Apply one edit to a stored sentence: append, drop the last character, clear."""
    held = F.coalesce(text, F.lit(""))
    return (
        F.when(action == "append", F.concat(held, char))
        .when(action == "space", F.concat(held, F.lit(" ")))
        .when(action == "backspace", F.left(held, F.greatest(F.length(held) - 1, F.lit(0))))
        .when(action == "clear", F.lit(""))
        .otherwise(held)
    )


def sign_kind(char: Column, has_asset: Column) -> Column:
    """How a character of a message is shown."""
    return (
        F.when(char == " ", F.lit("space"))
        .when(has_asset, F.lit("image"))
        .when(F.upper(char).rlike(ALPHABETIC), F.lit("motion"))
        .otherwise(F.lit("other"))
    )


def argmax_prediction(scores: Column, classes: Column) -> Column:
    """Best class as letter, label and confidence; ties go to the first class."""
    best = F.array_max(scores)
    letter = F.element_at(classes, F.array_position(scores, best).cast("int"))
    return F.struct(
        letter.alias("letter"),
        letter_to_label(letter).alias("label"),
        best.alias("confidence"),
    )


def topk_classes(scores: Column, classes: Column, k: int) -> Column:
    """The k most probable classes, best first, equal scores by class name."""
    pairs = F.zip_with(
        scores, classes, lambda p, c: F.struct((-p).alias("negated"), c.alias("letter"))
    )
    return F.transform(
        F.slice(F.array_sort(pairs), 1, k),
        lambda s: F.struct(s["letter"].alias("letter"), (-s["negated"]).alias("confidence")),
    )


def model_fallback(choices: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-null prediction in order, and the name of the model that gave it."""
    prediction = F.coalesce(*[c for _, c in choices])
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(name)) for name, c in choices])
    return prediction, source

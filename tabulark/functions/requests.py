"""Scoring requests: JSON text to a typed feature row, and the answer back to JSON.

A request field may be a JSON number or a string, and both the absence of a key
and the kind of its value decide whether the default applies, so requests are
kept as VARIANT until every field is typed. Nothing here throws: a request that
cannot be typed gets a message in ``error`` instead of stopping the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.passenger import family_size, is_alone, strip_blanks

INTEGER_TEXT = r"^[+-]?[0-9]+$"


def json_request_decode(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``request`` (VARIANT object). Malformed or empty JSON counts as ``{}``;
    JSON that is neither an object nor empty is reported in ``error``."""
    parsed = F.try_parse_json(F.col(body))
    kind = F.schema_of_variant(parsed)
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    empty = (
        parsed.isNull()
        | (kind == "VOID")
        | F.to_json(parsed).isin("{}", "[]", "0", "0.0", '""', "false", "null")
    )
    return df.withColumns(
        {
            "request": F.when(is_object, parsed).otherwise(F.parse_json(F.lit("{}"))),
            "error": F.when(~is_object & ~F.coalesce(empty, F.lit(True)),
                            F.lit("request is not an object")),
        }
    )


def _field(name: str) -> tuple[Column, Column]:
    """(kind, text) of one request field; the kind is null when the key is absent."""
    value = F.try_variant_get(F.col("request"), f"$.{name}", "variant")
    text = F.try_variant_get(F.col("request"), f"$.{name}", "string")
    return F.schema_of_variant(value), text


def _whole(kind: Column, text: Column) -> Column:
    """Integer reading: numbers are cut toward zero, strings must be whole numbers."""
    bare = strip_blanks(text)
    number = F.when(text.isin("true", "false"), (text == "true").cast("int")).otherwise(
        text.try_cast("double").try_cast("int")
    )
    return F.when(kind == "STRING", F.when(bare.rlike(INTEGER_TEXT), bare.try_cast("int"))).otherwise(
        number
    )


def _real(kind: Column, text: Column) -> Column:
    bare = strip_blanks(text)
    return F.when(text.isin("true", "false") & (kind == "BOOLEAN"),
                  (text == "true").cast("double")).otherwise(bare.try_cast("double"))


def _falsy(kind: Column, text: Column) -> Column:
    """Absent, null, empty text, false, or a number equal to zero."""
    zero = (kind != "STRING") & (text.try_cast("double") == 0)
    return kind.isNull() | (kind == "VOID") | (text == "") | (text == "false") | F.coalesce(
        zero, F.lit(False)
    )


def request_defaults(df: DataFrame) -> DataFrame:
    """Typed feature row with defaults and derived fields from ``request``.

    Numbers other than Pclass fall back on their default when missing, empty or
    zero; a string ``"0"`` is kept. Text fields fall back only when the key is
    absent. Unreadable values are named in ``error``.
    """
    defaults = K.REQUEST_DEFAULTS
    columns: dict[str, Column] = {}
    bad: list[Column] = []

    kind, text = _field("Pclass")
    whole = _whole(kind, text)
    columns["Pclass"] = F.when(kind.isNull(), F.lit(defaults["Pclass"])).otherwise(whole)
    bad.append(F.when(kind.isNotNull() & whole.isNull(), F.lit("Pclass")))

    for name, reader in [("Age", _real), ("SibSp", _whole), ("Parch", _whole), ("Fare", _real)]:
        kind, text = _field(name)
        missing = F.coalesce(_falsy(kind, text), F.lit(True))
        value = reader(kind, text)
        columns[name] = F.when(missing, F.lit(defaults[name])).otherwise(value)
        bad.append(F.when(~missing & value.isNull(), F.lit(name)))

    for name in ("Sex", "Embarked", "Title", "Deck"):
        kind, text = _field(name)
        columns[name] = F.when(kind.isNull(), F.lit(defaults[name])).otherwise(
            F.coalesce(text, F.lit(""))
        )

    problems = F.filter(F.array(*bad), lambda b: b.isNotNull())
    message = F.when(
        F.size(problems) > 0, F.concat(F.lit("unreadable: "), F.array_join(problems, ", "))
    )
    columns["error"] = F.coalesce(F.col("error"), message)
    # as a generated row: a filter on the result is not written out in terms of the request,
    # which would parse it hundreds of times
    fields = F.inline(F.array(F.struct(*[v.alias(c) for c, v in columns.items()])))
    ours = {c.lower(): c for c in columns}
    others = [c for c in df.columns if c.lower() not in ours]
    order = [ours.pop(c.lower(), c) for c in df.columns] + list(ours.values())
    typed = df.select(*others, fields).select(*order)
    size = family_size(F.col("SibSp"), F.col("Parch"))
    return typed.withColumns(
        {
            "FamilySize": size,
            "IsAlone": is_alone(size),
            "HasCabin": (F.col("Deck") != K.UNKNOWN_DECK).cast("int"),
        }
    ).drop("request")


def json_response_encode(prediction: Column, probability: Column) -> Column:
    """The answer as JSON text, probability to four digits."""
    return F.to_json(
        F.struct(
            prediction.cast("int").alias("prediction"),
            (prediction == 1).alias("survived"),
            F.bround(probability, 4).alias("probability"),
        )
    )

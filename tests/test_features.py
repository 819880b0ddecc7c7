"""Literal cases where Spark's own defaults would give something else."""

import json

from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions import letters as L
from tabulark.functions import passenger as P
from tabulark.functions.requests import json_request_decode, json_response_encode, request_defaults


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_titles(spark):
    names = [
        "Braund, Mr. Owen", 'Khalil, Mrs. Mariana (Miriam")"', "Rothes, the Countess. of (Lucy)",
        "no title", None, "A, Mlle. B", "A, Ms. B", "A, Mme. B", "A, Jonkheer. B", "A, Countess. B",
        "A,  Dr . B", "first, second, Don. x",
    ]
    got = values(
        spark, [(n,) for n in names], "n string", P.title_group(P.title_extract(F.col("n")))
    )
    assert got == [
        "Mr", "Mrs", "the Countess", None, None, "Miss", "Miss", "Mrs", "Rare", "Rare", "Rare",
        "second, Don",
    ]


def test_engineered_columns(spark):
    df = spark.createDataFrame(
        [("A, Mr. B", 0, 0, None), ("A, Mr. B", None, 1, ""), ("A, Mr. B", 1, 2, "C85 C87")],
        "Name string, SibSp int, Parch int, Cabin string",
    )
    got = [tuple(r)[4:] for r in P.engineer_features(df).collect()]
    assert got == [
        ("Mr", 1, 1, "Unknown", 0), ("Mr", None, 0, "Unknown", 1), ("Mr", 4, 0, "C", 1),
    ]


def test_rounding_is_half_even(spark):
    assert values(spark, [(0.1225,), (0.1235,)], "r double", P.percent_round(F.col("r"))) == [12.2, 12.4]


def test_value_map_leaves_unknown_null(spark):
    got = values(spark, [(0,), (1,), (2,), (None,)], "v int", P.value_map(F.col("v"), K.OUTCOME_NAMES))
    assert got == ["Died", "Survived", None, None]


def test_letters(spark):
    assert values(spark, [(0,), (24,), (25,), (26,), (-1,), (None,)], "v int", L.label_to_letter(F.col("v"))) == [
        "A", "Y", "Z", "?", "?", "?"]
    assert values(spark, [("A",), ("Z",), ("a",), ("AB",), ("",), ("?",)], "v string",
                  L.letter_to_label(F.col("v"))) == [0, 25, -1, -1, -1, -1]
    texts = ["a", " Sign_b", "SPACE", "blank ", "del", "None", "", "  ", "7: é", "12", "\tnothing\n"]
    got = values(spark, [(t,) for t in texts], "v string", L.normalize_label(F.col("v")))
    assert got == ["A", "S", " ", " ", "?", "?", "?", "?", "É", "?", "?"]


def test_text_edit(spark):
    rows = [("ab", "append", "c"), ("ab", "backspace", None), ("", "backspace", None), ("ab", "clear", None),
            (None, "space", None), ("ab", "other", None)]
    column = L.text_edit(F.col("t"), F.col("a"), F.col("c"))
    assert values(spark, rows, "t string, a string, c string", column) == ["abc", "a", "", "", " ", "ab"]


def test_word_letters(spark):
    assert values(spark, [("Hello",), ("jazz!",), ("",)], "w string", L.word_bad_letters(F.col("w"))) == [
        [], ["J", "Z", "Z", "!"], []]


def test_scores(spark):
    classes = F.array(*map(F.lit, "CAB"))
    rows = [([0.4, 0.2, 0.4],), ([0.1, 0.8, 0.1],)]
    best = values(spark, rows, "s array<double>", L.argmax_prediction(F.col("s"), classes))
    assert [(b.letter, b.label, b.confidence) for b in best] == [("C", 2, 0.4), ("A", 0, 0.8)]
    top = values(spark, rows, "s array<double>", L.topk_classes(F.col("s"), classes, 2))
    assert [[x.letter for x in t] for t in top] == [["B", "C"], ["A", "B"]]


def request(spark, body):
    df = spark.createDataFrame([(body,)], "body string")
    return request_defaults(json_request_decode(df)).first().asDict()


def test_request_defaults(spark):
    assert request(spark, "{}") == {
        "body": "{}", "error": None, "Pclass": 3, "Age": 30.0, "SibSp": 0, "Parch": 0, "Fare": 32.0,
        "Sex": "male", "Embarked": "S", "Title": "Mr", "Deck": "Unknown", "FamilySize": 1,
        "IsAlone": 1, "HasCabin": 0,
    }
    for body in ("{broken", "", "[]", "null", None, "0"):
        assert request(spark, body)["error"] is None and request(spark, body)["Age"] == 30.0
    assert request(spark, "[1]")["error"] == "request is not an object"
    assert request(spark, '{"Age": 0, "Fare": ""}')["Age"] == 30.0
    assert request(spark, '{"Age": "0"}')["Age"] == 0.0
    assert request(spark, '{"SibSp": "2", "Parch": 1.9}')["FamilySize"] == 4
    assert request(spark, '{"Pclass": ""}')["error"] == "unreadable: Pclass"
    assert request(spark, '{"Pclass": null}')["error"] == "unreadable: Pclass"
    assert request(spark, '{"SibSp": "1.5", "Age": "x"}')["error"] == "unreadable: Age, SibSp"
    assert request(spark, '{"Deck": "C"}')["HasCabin"] == 1
    assert request(spark, '{"Title": ""}')["Title"] == ""


def test_response(spark):
    text = values(spark, [(1, 0.71436)], "p int, q double", json_response_encode(F.col("p"), F.col("q")))[0]
    assert json.loads(text) == {"prediction": 1, "survived": True, "probability": 0.7144}

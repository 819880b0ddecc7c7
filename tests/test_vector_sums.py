"""Element-wise sums by key, moments of all elements and digests, against plain Python."""

import math
import random

import pytest

from tabulark.operators import profile, vector_sums
from tabulark.operators.vector_sums import element_moments
from pyspark.sql import functions as F

SCHEMA = "g double, p array<double>, key string, sums string"


def rows_of(n):
    draw = random.Random(5)
    out = []
    for _ in range(n):
        g = draw.choice([0.0, -0.0, 1.0, math.nan, None])
        p = [draw.choice([None, math.nan, draw.random() * 100]) for _ in range(draw.choice([0, 1, 3, 40]))]
        out.append((g, draw.choice([None, p, p, p]), "k", "s"))
    return out


def brute(rows):
    sums = {}
    for g, p, *_ in rows:
        g = "nan" if g is not None and g != g else None if g is None else g + 0.0
        held = sums.setdefault(g, [])
        for i, x in enumerate(p or []):
            while len(held) <= i:
                held.append((0.0, 0))
            if x is not None and x == x:
                held[i] = held[i][0] + x, held[i][1] + 1
    return sums


@pytest.mark.parametrize("parts,cells", [(1, 1 << 21), (7, 1 << 21), (3, 50)])
def test_sums_are_those_of_a_loop(spark, monkeypatch, parts, cells):
    monkeypatch.setattr(vector_sums, "CELLS", cells)
    rows = rows_of(300)
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = vector_sums.vector_sums(table, "g", F.col("p")).collect()
    want = brute(rows)
    assert len(got) == len(want)
    for r in got:
        held = want["nan" if r.g is not None and r.g != r.g else r.g]
        assert [c for _, c in held] == r.counts
        assert all(math.isclose(a, s, abs_tol=1e-9) for (a, _), s in zip(held, r.sums))


def test_moments_of_all_elements(spark):
    rows = rows_of(200)
    flat = [1e6 + x for _, p, *_ in rows for x in p or [] if x is not None and x == x]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    shifted = table.withColumn("p", F.transform("p", lambda x: x + 1e6))
    got = element_moments(shifted, F.col("p")).first()
    mean = sum(flat) / len(flat)
    assert math.isclose(got["mean"], mean)
    assert math.isclose(got["std"], math.sqrt(sum((x - mean) ** 2 for x in flat) / len(flat)), rel_tol=1e-5)


def test_empty_tables_and_labels_without_a_pixel(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert profile.class_mean_image(none, "g", "p").collect() == []
    assert tuple(profile.pixel_moments(none, "p").first()) == (None, None)
    some = spark.createDataFrame([("a", None), ("b", []), ("c", [None]), (None, [2.0])], "l string, p array<double>")
    got = {r.l: r.brightness for r in profile.class_brightness(some, "l", "p").collect()}
    assert got == {"c": None, None: 2.0}


def test_duplicates_by_digest(spark):
    rows = [("ab", "c", 0.0), ("a", "bc", 0.0), (None, "x", math.nan), ("x", None, math.nan),
            ("x", None, math.nan), ("ab", "c", -0.0), (None, None, None), (None, None, None)]
    table = spark.createDataFrame(rows, "a string, b string, c double").repartition(3)
    assert profile.duplicate_count(table).first()[0] == 3
    assert profile.duplicate_count(table.limit(0)).first()[0] == 0
    nested = spark.createDataFrame([([1, None],), ([None, 1],), ([1, None],)], "a array<int>")
    assert profile.duplicate_count(nested).first()[0] == 1

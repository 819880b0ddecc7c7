"""Profiling, percentiles, sampling, cleaning and evaluation on small tables."""

import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest

from tabulark.operators import cleaning, evaluation, profile, quantiles, sampling


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds most rows."""
    rng = random.Random(3)
    rows = [(i, "hot" if i % 10 < 7 else rng.choice("abc")) for i in range(2003)]
    return spark.createDataFrame(rows, "id long, label string").cache()


@pytest.mark.parametrize("gather", [5, 50, 10**6])
def test_percentiles_are_exact(spark, gather):
    rng = random.Random(1)
    values = [rng.choice([1.0, 1.0, 1.0, 2.5, rng.random() * 9, None, float("nan")]) for _ in range(999)]
    df = spark.createDataFrame([(v, -5) for v in values], "v double, k int")
    kept = np.array([v for v in values if v is not None and v == v])
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles.exact_percentiles(df, ["v", "k"], probs, gather)
    assert np.allclose(got["v"], np.quantile(kept, probs))
    assert got["k"] == [-5.0] * 6


def test_percentile_of_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_percentiles(df, ["v"], [0.5]) == {"v": [None]}


def test_even_median_and_describe(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0, None)], "v double")
    r = profile.describe_numeric(df, ["v"]).first()
    assert (r["count"], r["q50"], r["min"], r["max"]) == (4, 3.0, 1.0, 9.0)
    assert math.isclose(r["std"], statistics.stdev([1, 2, 4, 9]))


def test_missing(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, float("nan"), None), (3, 1.0, "y")], "a int, b double, c string")
    assert rows_of(profile.missing_profile(df)) == [("b", 2, 66.7), ("c", 1, 33.3)]
    assert profile.missing_total(df).first()[0] == 3


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_matches_numpy(spark, bins):
    rng = random.Random(7)
    rows = [(i % 2, None if i % 9 == 0 else float(rng.randint(0, 60)) / 2) for i in range(500)] + [(5, 3.0)]
    out = profile.histogram_equal(spark.createDataFrame(rows, "g int, v double"), "v", bins, "g").collect()
    for group in (0, 1, 5):
        values = [v for g, v in rows if g == group and v is not None]
        want, edges = np.histogram(values, bins)
        got = sorted((r["bin"], r["count"], r["low"]) for r in out if r["g"] == group)
        assert [c for _, c, _ in got] == want.tolist()
        assert np.allclose([low for _, _, low in got], edges[:-1])


def test_nice_width():
    assert profile.nice_width(0, 78, 30) == 5
    assert profile.nice_width(0, 30, 30) == 1
    assert profile.nice_width(0, 0.31, 30) == 0.02
    assert profile.nice_width(1, 1, 30) > 0


def test_duplicates_and_cleaning(spark):
    rows = [(1, 5, None), (1, 5, None), (2, 3, 4), (2, 3, 4), (2, 3, 4), (99, 1, 1), (None, 1, 1), (-1, 2, 2)]
    df = spark.createDataFrame(rows, "label int, pixel1 int, pixel2 int")
    assert profile.duplicate_count(df).first()[0] == 3
    assert rows_of(cleaning.clean_table(df)) == [(2, 3, 4)]
    assert tuple(profile.clean_removed(df, cleaning.clean_table).first()) == (8, 1, 7)
    assert profile.bad_label_count(df, "label", 25).first()[0] == 2


def test_wide_cleaning_equals_packed(spark):
    rng = random.Random(2)
    side = 12
    rows = []
    for i in range(60):
        row = [rng.choice([0, 3, 24, 25, None]), *[rng.choice([0, 255, 7]) for _ in range(side * side)]]
        if i % 7 == 0:
            row[5] = None
        rows += [tuple(row)] * (1 + i % 3)
    schema = "label int, " + ", ".join(f"pixel{i + 1} int" for i in range(side * side))
    df = spark.createDataFrame(rows, schema)
    want = {r for r in rows if None not in r and 0 <= r[0] < 25}
    assert {tuple(r) for r in cleaning.clean_table(df).collect()} == want
    images = cleaning.pixel_dataset(df, df, side).where("split = 'test'").collect()
    flat = Counter((r["label"], tuple(round(p * 255) for line in r["image"] for p in line)) for r in images)
    assert flat == Counter((r[0], r[1:]) for r in want)


def test_kfold_is_balanced(spark, skewed):
    out = sampling.stratified_kfold(skewed, "label", "id", 5).collect()
    sizes = Counter(r["fold"] for r in out)
    assert len(out) == 2003 and max(sizes.values()) - min(sizes.values()) <= 1
    for label in ("hot", "a", "b", "c"):
        per = Counter(r["fold"] for r in out if r["label"] == label)
        assert max(per.values()) - min(per.values()) <= 1
    with pytest.raises(ValueError):
        sampling.stratified_kfold(skewed, "label", "id", 5000)


def test_split_quotas(spark, skewed):
    out = sampling.stratified_split(skewed, "label", "id", 0.15).collect()
    sizes = Counter(r["label"] for r in out)
    test = Counter(r["label"] for r in out if r["split"] == "test")
    wanted = math.ceil(0.15 * sum(sizes.values()))
    exact = {c: n * wanted / sum(sizes.values()) for c, n in sizes.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    for c in sorted(sizes, key=lambda c: (quota[c] - exact[c], c))[: wanted - sum(quota.values())]:
        quota[c] += 1
    assert test == Counter(quota)
    assert sum(test.values()) == math.ceil(0.15 * 2003)
    assert all(abs(test[c] - 0.15 * n) <= 1 for c, n in sizes.items())


@pytest.mark.parametrize("digits", [1, 3])
def test_shuffled_position(spark, skewed, digits):
    out = sampling.shuffled_position(skewed, "id", 7, strata="label", digits=digits).collect()
    for label in ("hot", "a"):
        assert sorted(r["position"] for r in out if r["label"] == label) == list(
            range(sum(r["label"] == label for r in out)))
    import hashlib
    hot = [r["id"] for r in sorted(out, key=lambda r: r["position"]) if r["label"] == "hot"]
    assert hot == sorted(hot, key=lambda i: hashlib.md5(f"7-{i}".encode()).hexdigest())


def test_samples(spark, skewed, monkeypatch):
    import hashlib

    ids = sorted((r["id"] for r in skewed.collect()), key=lambda i: hashlib.md5(f"1-{i}".encode()).hexdigest())
    for n in (0, 1, 30, len(ids) - 1, len(ids)):
        assert {r["id"] for r in sampling.sample_n(skewed, n, "id", 1).collect()} == set(ids[:n])
    with pytest.raises(ValueError):
        sampling.sample_n(skewed, 3000, "id", 1)
    monkeypatch.setattr(sampling, "GROUP_SLICES", 3)
    firsts = sampling.first_n_per_group(skewed, "label", ["id"], 4).collect()
    want = [i for i, r in enumerate(sorted(skewed.collect())) if r["label"] == "hot"][:4]
    assert sorted(r["id"] for r in firsts if r["label"] == "hot") == want
    assert len(firsts) == 16
    assert len(sampling.sample_one_per_key(skewed, "label", "id", 3).collect()) == 4


def report(actual, predicted):
    out = {}
    for c in sorted(set(actual) | set(predicted)):
        tp = sum(a == p == c for a, p in zip(actual, predicted))
        called, real = predicted.count(c), actual.count(c)
        p, r = (tp / called if called else 0.0), (tp / real if real else 0.0)
        out[c] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, real)
    return out


def test_report_and_matrix(spark):
    rng = random.Random(4)
    actual = [rng.choice([0, 1, 2, 4]) for _ in range(300)]
    predicted = [a if rng.random() < 0.7 else rng.choice([0, 1, 3]) for a in actual]
    df = spark.createDataFrame(list(zip(actual, predicted)), "a int, p int")
    want = report(actual, predicted)
    got = {r["class"]: r for r in evaluation.classification_report(df, "a", "p", digits=9).collect()}
    for c, (p, r, f, n) in want.items():
        row = got[str(c)]
        assert np.allclose([row.precision, row.recall, row.f1], [p, r, f], atol=1e-8) and row.support == n
    assert math.isclose(got["accuracy"].f1, np.mean(np.array(actual) == predicted), abs_tol=1e-8)
    assert math.isclose(got["macro avg"].f1, np.mean([w[2] for w in want.values()]), abs_tol=1e-8)
    assert math.isclose(
        got["weighted avg"].recall, sum(w[1] * w[3] for w in want.values()) / 300, abs_tol=1e-8)
    grid = {(r.actual, r.predicted): r["count"] for r in evaluation.confusion_matrix(df, "a", "p").collect()}
    pairs = Counter(zip(actual, predicted))
    assert grid == {(a, p): pairs[(a, p)] for a in range(5) for p in range(5)}


def test_report_over_a_subset(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 1), (1, 1)], "a int, p int")
    got = {r["class"]: r for r in evaluation.classification_report(df, "a", "p", labels=[1, 7]).collect()}
    assert "accuracy" not in got and got["micro avg"].support == 2
    assert (got["1"].precision, got["1"].recall, got["7"].support) == (0.5, 0.5, 0)
    named = evaluation.classification_report(df, "a", "p", labels=[0, 1, 2], names={0: "zero"}).collect()
    assert {"zero", "accuracy"} <= {r["class"] for r in named}


def test_binary_without_positive_calls(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "a int, p int")
    assert tuple(evaluation.binary_metrics(df, "a", "p").first()) == (0.5, 0.0, 0.0, 0.0)


def test_best_model_ties_go_to_the_first(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "model string, score double")
    assert sampling.best_model(df, ["b", "a", "c"], "model", "score").first()["model"] == "b"


def test_guard(spark):
    with pytest.raises(ValueError):
        cleaning.min_rows_guard(spark.range(49))
    assert cleaning.min_rows_guard(spark.range(50)).count() == 50


def test_class_images(spark):
    df = spark.createDataFrame([(1, [0, 4]), (1, [2, 8]), (2, [5, 5])], "label int, pixels array<int>")
    got = {r["label"]: r["mean_image"] for r in profile.class_mean_image(df, "label", "pixels").collect()}
    assert got == {1: [1.0, 6.0], 2: [5.0, 5.0]}
    assert {r["label"]: r["brightness"] for r in profile.class_brightness(df, "label", "pixels").collect()} == {
        1: 3.5, 2: 5.0}

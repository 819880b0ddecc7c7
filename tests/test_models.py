"""Preprocessing against NumPy, models, files and stream scoring."""

import json
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.requests import json_request_decode, request_defaults
from tabulark.operators import landmark_jobs, models, preprocess, sampling
from tabulark.session import scratch_path
from tabulark.sources import tables
from tabulark.streaming.scoring import run_to_files, score_requests

SCHEMA = (
    "PassengerId int, Survived int, Age double, Fare double, FamilySize int, SibSp int, Parch int, "
    "IsAlone int, HasCabin int, Pclass int, Sex string, Embarked string, Title string, Deck string"
)


@pytest.fixture(scope="module")
def passengers(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        sex = rng.choice(["male", "female"])
        sibsp, parch = rng.randint(0, 3), rng.randint(0, 2)
        survived = int(rng.random() < (0.8 if sex == "female" else 0.15))
        rows.append((
            i, survived, None if i % 5 == 0 else rng.uniform(1, 80), rng.expovariate(0.03),
            sibsp + parch + 1, sibsp, parch, int(sibsp + parch == 0), 0, rng.randint(1, 3), sex,
            None if i % 60 == 0 else rng.choice("SCQ"), rng.choice(["Mr", "Mrs", "Miss"]), "Unknown",
        ))
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def fitted(passengers):
    return models.fit_model(passengers, models.logistic_regression)


def matrix(df):
    rows = df.select("PassengerId", vector_to_array("features").alias("v")).orderBy("PassengerId").collect()
    return np.array([r["v"] for r in rows])


def test_preprocess_matches_numpy(spark, passengers):
    model = preprocess.TabularPreprocessor().fit(passengers)
    out = model.transform(passengers)
    names = preprocess.feature_names(out)
    got = dict(zip(names, matrix(out).T))
    table = passengers.orderBy("PassengerId").toPandas()
    for c in K.NUMERIC_FEATURES:
        v = table[c].astype(float).to_numpy()
        v = np.where(np.isnan(v), np.nanmedian(v), v)
        spread = v.std() or 1.0  # a constant column is only centred
        assert np.allclose(got[f"num__{c}"], (v - v.mean()) / spread), c
    for c in K.CATEGORICAL_FEATURES:
        v = table[c].dropna().astype(str)
        counts = v.value_counts()
        mode = sorted(counts[counts == counts.max()].index)[0]
        filled = table[c].astype(object).where(table[c].notna(), mode).astype(str)
        for category in sorted(v.unique()):
            assert np.array_equal(got[f"cat__{c}_{category}"], (filled == category).astype(float))
    assert len(names) == 7 + sum(passengers.select(c).dropna().distinct().count() for c in K.CATEGORICAL_FEATURES)


def test_unseen_category_is_all_zero(spark, passengers):
    model = preprocess.TabularPreprocessor().fit(passengers)
    strange = passengers.limit(1).withColumn("Sex", F.lit("unseen"))
    out = model.transform(strange)
    slots = dict(zip(preprocess.feature_names(out), matrix(out)[0]))
    assert slots["cat__Sex_male"] == 0 and slots["cat__Sex_female"] == 0


def test_empty_column_is_refused(passengers):
    with pytest.raises(ValueError, match="Age"):
        preprocess.TabularPreprocessor().fit(passengers.withColumn("Age", F.lit(None).cast("double")))


def test_mode_tie_and_median(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), (None, 4.0), ("a", 9.0), ("b", None)], "c string, v double")
    assert preprocess.fit_mode(df, ["c"]).first()["mode"] == "a"
    assert preprocess.fit_median(df, ["v"]).first()["median"] == 3.0


def test_logistic_regression_is_the_ridge_optimum(passengers, fitted):
    """Zero gradient of half the squared weights plus the summed loss."""
    out = fitted.transform(passengers)
    x = matrix(out)
    y = np.array([r[0] for r in passengers.orderBy("PassengerId").select("Survived").collect()])
    last = fitted.stages[-1]
    w, b = last.coefficients.toArray(), last.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(w + x.T @ (p - y)).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_oof_covers_every_row_once_without_leak(passengers):
    folds = sampling.stratified_kfold(passengers, "Survived", "PassengerId", 3)
    out = models.oof_predictions(folds, models.logistic_regression, ["PassengerId", "Survived"]).collect()
    assert sorted(r["PassengerId"] for r in out) == list(range(300))
    want = {r["PassengerId"]: r["fold"] for r in folds.collect()}
    assert all(want[r["PassengerId"]] == r["fold"] for r in out)
    accuracy = np.mean([r["Survived"] == r["prediction"] for r in out])
    majority = max(np.mean([r["Survived"] for r in out]), 1 - np.mean([r["Survived"] for r in out]))
    assert accuracy > majority + 0.1


def test_compare_models(passengers):
    folds = sampling.stratified_kfold(passengers, "Survived", "PassengerId", 2)
    scores = models.cv_compare(folds, models=models.candidate_models(trees=5, rounds=3)).collect()
    assert {(r["model"], r["fold"]) for r in scores} == {
        (m, k) for m in ("LogisticRegression", "RandomForest", "GradientBoosting") for k in (0, 1)}
    assert all(0.6 < r["accuracy"] <= 1 for r in scores)


def test_importance_names(spark, passengers, fitted):
    linear = models.feature_importance(fitted, fitted.transform(passengers)).collect()
    assert {"Age", "Sex_male", "Pclass_1"} <= {r["feature"] for r in linear}
    assert all(r["importance"] >= 0 for r in linear)
    forest = models.fit_model(passengers, lambda n: models.random_forest(n, trees=5))
    ranked = models.feature_importance(forest, forest.transform(passengers)).collect()
    assert abs(sum(r["importance"] for r in ranked) - 1) < 1e-6
    assert max(ranked, key=lambda r: r["importance"])["feature"].startswith("Sex_")


def test_saved_model_predicts_the_same(spark, passengers, fitted):
    path = scratch_path(spark, "model")
    with pytest.raises(FileNotFoundError):
        tables.load_model(spark, path)
    tables.save_model(fitted, path)
    keep = ["PassengerId"]
    before = models.batch_score(fitted, passengers, keep).orderBy("PassengerId").collect()
    after = models.batch_score(tables.load_model(spark, path), passengers, keep).orderBy("PassengerId").collect()
    assert before == after


BODIES = [
    "{}", "{bad", '{"Sex": "female", "Age": 28, "Fare": 80, "Title": "Mrs", "Deck": "C", "Pclass": 1}',
    '{"Pclass": ""}', "[1]", '{"Sex": "martian"}',
]


def test_stream_scoring_equals_batch(spark, fitted):
    source = scratch_path(spark, "requests")
    requests = spark.createDataFrame(list(enumerate(BODIES)), "id int, body string")
    requests.repartition(3).write.parquet(source)
    arriving = spark.readStream.schema("id int, body string").option("maxFilesPerTrigger", 1).parquet(source)
    out = scratch_path(spark, "answers")
    run_to_files(score_requests(arriving, fitted, ["id"]), out, scratch_path(spark, "state"))
    streamed = spark.read.parquet(out).orderBy("id").collect()
    assert streamed == score_requests(requests, fitted, ["id"]).orderBy("id").collect()
    by_id = {r["id"]: r for r in streamed}
    assert by_id[3]["response"] is None and by_id[3]["error"] == "unreadable: Pclass"
    assert by_id[4]["response"] is None
    assert json.loads(by_id[0]["response"]) == json.loads(by_id[1]["response"])
    answer = json.loads(by_id[2]["response"])
    assert answer["survived"] is True and answer["prediction"] == 1 and 0.5 < answer["probability"] <= 1
    rows = request_defaults(json_request_decode(requests)).where("error IS NULL")
    assert models.batch_score(fitted, rows, ["id"]).count() == 4


def test_a_filter_on_decoded_requests_does_not_parse_them_again(spark, capsys):
    requests = spark.createDataFrame(list(enumerate(BODIES)), "id int, body string")
    rows = request_defaults(json_request_decode(requests))
    assert rows.columns[:4] == ["id", "body", "error", "Pclass"]
    readable = rows.where("error IS NULL")
    readable.explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("==")[0]
    assert 0 < plan.count("parseJson") < 20
    assert sorted(r["id"] for r in readable.collect()) == [0, 1, 2, 5]


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    rows = [(1, 3, 'Khalil, Mrs. Mariana (Miriam")"', "female", None, 0, 1, "A/5", 7.25, None, "S")]
    df = spark.createDataFrame(rows, tables.PASSENGER_SCHEMA)
    df.write.option("header", True).option("escape", '"').csv(path)
    assert tables.csv_scan(spark, path, tables.PASSENGER_SCHEMA).collect() == df.collect()
    with pytest.raises(FileNotFoundError, match="no table at"):
        tables.csv_scan(spark, path + "-absent", tables.PASSENGER_SCHEMA)


def test_stage_cache_builds_once(spark):
    path, built = scratch_path(spark, "stage"), []

    def build():
        built.append(1)
        return spark.range(5)

    for use_cache, expected in ((True, 1), (True, 1), (False, 2)):
        assert tables.stage_cache(spark, path, build, use_cache).count() == 5
        assert len(built) == expected


def test_landmark_perceptron(spark):
    rng = np.random.default_rng(5)
    shapes = rng.uniform(0, 1, (3, 21, 3))
    rows = [
        (i, "Right", "ABC"[i % 3], [tuple(map(float, q)) for q in shapes[i % 3] + rng.normal(0, 0.01, (21, 3))])
        for i in range(90)
    ]
    df = spark.createDataFrame(
        rows, "id long, hand string, letter string, points array<struct<x: double, y: double, z: double>>")
    data = landmark_jobs.landmark_training_table(df, "id", "points", "letter", "hand").cache()
    model = models.landmark_mlp(data.where("split = 'train'"), iterations=30)
    held = models.apply_perceptron(model, data.where("split = 'test'")).select("letter", "predicted").collect()
    assert len(held) == 14 and np.mean([r["letter"] == r["predicted"] for r in held]) > 0.9


def test_fits_are_dealt_to_tasks_of_bounded_size(spark, passengers, monkeypatch):
    """A table in one file is not one task of a fit, neither alone nor in the comparison."""
    monkeypatch.setattr(models, "TASK_ROWS", 20)
    monkeypatch.setattr(models, "LEAST_ROWS", 5)
    seen = []

    class Recorded(models.LogisticRegression):
        def _fit(self, dataset):
            sizes = dataset.rdd.glom().map(len).collect()
            seen.append((sum(sizes), max(sizes)))
            return super()._fit(dataset)

    def maker(n):
        return Recorded(labelCol="Survived", regParam=1.0 / n)

    whole = spark.createDataFrame(passengers.collect(), SCHEMA).coalesce(1)
    models.fit_model(whole, maker)
    folds = sampling.stratified_kfold(whole, "Survived", "PassengerId")
    models.cv_compare(folds, models={"LogisticRegression": maker})
    assert sorted(n for n, _ in seen) == [240] * 5 + [300]
    assert all(most <= 21 for _, most in seen)


def test_comparison_holds_the_out_of_fold_predictions(passengers):
    folds = sampling.stratified_kfold(passengers, "Survived", "PassengerId")
    keep = ["PassengerId", "Survived"]
    alone = models.oof_predictions(folds, models.logistic_regression, keep)
    both = models.cv_predictions(
        folds, keep, models=models.candidate_models(trees=3, rounds=2)
    )
    own = both.where("model = 'LogisticRegression'").drop("model")
    assert own.columns == alone.columns

    def rows(df):
        return {r["PassengerId"]: r for r in df.collect()}

    got, want = rows(own), rows(alone)
    assert len(got) == len(want) == 300 and both.count() == 900
    assert all(
        got[i][c] == want[i][c] for i in want for c in ("Survived", "fold", "prediction")
    )
    assert max(abs(got[i]["probability"] - want[i]["probability"]) for i in want) < 1e-3


def test_boostings_of_all_folds_share_their_jobs(spark, passengers):
    """A level of a round is one job, however many folds there are."""
    context = spark.sparkContext
    folds = sampling.stratified_kfold(passengers, "Survived", "PassengerId").cache()

    def jobs(rounds):
        group = f"comparison of {rounds} rounds"
        context.setJobGroup(group, group)
        try:
            maker = models.candidate_models(rounds=rounds)["GradientBoosting"]
            assert models.cv_compare(folds, models={"GradientBoosting": maker}).count() == 5
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(group))

    assert 0 < jobs(12) - jobs(2) < 2 * 10 * K.BOOST_DEPTH

"""Queries that fit or apply models, all at their full settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.passenger import engineer_features
from tabulark.functions.requests import json_request_decode, json_response_encode, request_defaults
from tabulark.operators import evaluation, landmark_jobs, models, preprocess, sampling
from tabulark.plans import survival
from tabulark.plans.fixtures import REQUESTS, view, with_views
from tabulark.plans.registry import query
from tabulark.session import named_path, scratch_path, stage_table
from tabulark.sources import tables
from tabulark.streaming.scoring import run_to_files, score_requests

LABEL = "Survived"


_SPLIT = """
sizes AS (SELECT {label} AS c, count(*) AS n FROM items GROUP BY c),
wanted AS (SELECT CAST(ceil(0.15 * sum(n)) AS BIGINT) AS w, CAST(sum(n) AS BIGINT) AS total FROM sizes),
shares AS (SELECT c, n * w / total AS exact, floor(n * w / total) AS base, w FROM sizes, wanted),
quota AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, c)
  <= w - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM shares),
parted AS (SELECT h.*, CASE WHEN row_number() OVER (PARTITION BY h.{label}
  ORDER BY md5(concat('0-', h.vec_id)), h.vec_id) <= q THEN 'test' ELSE 'train' END AS split
 FROM items h JOIN quota ON h.{label} = quota.c) """
SPLIT_HANDS = with_views(
    "landmarks", "items AS (SELECT DISTINCT vec_id, letter FROM landmarks)," + _SPLIT.format(label="letter")
)
SPLIT_PIXELS = with_views(
    "pixels", "items AS (SELECT vec_id, label FROM pixels)," + _SPLIT.format(label="label")
)


def training(spark, sf) -> DataFrame:
    return survival.engineered(spark, sf).select(
        "PassengerId", LABEL, *K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES
    )


# --- preprocessing -----------------------------------------------------------

_NUM = K.NUMERIC_FEATURES
_CAT = K.CATEGORICAL_FEATURES
PREPROCESSED = survival.ENGINEERED + """
, medians AS (SELECT """ + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in _NUM) + """ FROM engineered),
filled AS (SELECT e.PassengerId, """ + ", ".join(f"coalesce(CAST(e.{c} AS DOUBLE), m.{c}) AS {c}" for c in _NUM) + """
 FROM engineered e, medians m),
moments AS (SELECT """ + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _NUM) + """ FROM filled),
longcat AS (""" + " UNION ALL ".join(
    f"SELECT PassengerId, '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM engineered" for c in _CAT) + """),
catcount AS (SELECT col, value, count(*) AS n FROM longcat WHERE value IS NOT NULL GROUP BY ALL),
modes AS (SELECT col, value AS mode FROM catcount
 QUALIFY row_number() OVER (PARTITION BY col ORDER BY n DESC, value) = 1),
onehot AS (SELECT l.PassengerId, 'cat__' || l.col || '_' || coalesce(l.value, m.mode) AS name, 1.0::DOUBLE AS value
 FROM longcat l JOIN modes m ON m.col = l.col)
""" + " UNION ALL ".join(
    f"SELECT PassengerId, 'num__{c}' AS name, round((f.{c} - {c}_m) / CASE WHEN {c}_s > 0 THEN {c}_s ELSE 1 END, 5)"
    f" + 0.0 AS value FROM filled f, moments" for c in _NUM
) + " UNION ALL SELECT PassengerId, name, value FROM onehot"


PREPROCESSED_NAMES = survival.ENGINEERED + ", longcat AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM engineered" for c in _CAT
) + "), names AS (SELECT DISTINCT 'cat__' || col || '_' || value AS name FROM longcat WHERE value IS NOT NULL" + "".join(
    f" UNION ALL SELECT 'num__{c}'" for c in _NUM) + ") "


@query("preprocess_fit_transform", PREPROCESSED)
def preprocess_fit_transform(spark, sf):
    """Every numeric slot and every set one-hot slot of the feature vectors."""
    from pyspark.ml.functions import vector_to_array

    df = training(spark, sf)
    out = preprocess.TabularPreprocessor().fit(df).transform(df)
    names = F.array(*[F.lit(n) for n in preprocess.feature_names(out)])
    slots = out.select("PassengerId", F.explode(F.arrays_zip(
        names.alias("name"), vector_to_array("features").alias("value"))).alias("s")).select("PassengerId", "s.*")
    return slots.where("name LIKE 'num%' OR value <> 0").withColumn(
        "value", F.round("value", 5) + F.lit(0.0)
    )


# --- requests ----------------------------------------------------------------

DECODED = with_views("requests", """
parsed AS (SELECT id, CASE WHEN json_valid(body) AND body LIKE '{%' THEN body ELSE '{}' END AS j,
  CASE WHEN body = '[1]' THEN 'request is not an object' END AS e FROM requests) """)


@query("json_request_decode", DECODED + """
SELECT id, e AS error, j->>'$.Sex' AS sex, TRY_CAST(j->>'$.Pclass' AS DOUBLE) AS pclass,
 TRY_CAST(j->>'$.Age' AS DOUBLE) AS age, TRY_CAST(j->>'$.Fare' AS DOUBLE) AS fare, j->>'$.Deck' AS deck
FROM parsed""")
def _(spark, sf):
    out = json_request_decode(view(spark, sf, "requests"))

    def text(name):
        return F.try_variant_get(F.col("request"), f"$.{name}", "string")

    return out.select(
        "id", "error", text("Sex").alias("sex"), text("Pclass").try_cast("double").alias("pclass"),
        text("Age").try_cast("double").alias("age"), text("Fare").try_cast("double").alias("fare"),
        text("Deck").alias("deck"),
    )


def _number(name: str, default: float) -> str:
    kind, text = f"json_type(j, '$.{name}')", f"j->>'$.{name}'"
    return (
        f"CASE WHEN {kind} IS NULL OR {kind} = 'NULL' OR ({text}) = '' "
        f"OR {kind} <> 'VARCHAR' AND TRY_CAST({text} AS DOUBLE) = 0 "
        f"THEN {default}::DOUBLE ELSE TRY_CAST({text} AS DOUBLE) END"
    )


DEFAULTED = DECODED + f"""
, typed AS (SELECT id, e,
  CASE WHEN json_type(j, '$.Pclass') IS NULL THEN 3 ELSE CAST(TRY_CAST(j->>'$.Pclass' AS DOUBLE) AS INT) END AS Pclass,
  {_number('Age', 30)} AS Age, CAST({_number('SibSp', 0)} AS INT) AS SibSp,
  CAST({_number('Parch', 0)} AS INT) AS Parch, {_number('Fare', 32)} AS Fare,
  coalesce(j->>'$.Sex', 'male') AS Sex, coalesce(j->>'$.Embarked', 'S') AS Embarked,
  coalesce(j->>'$.Title', 'Mr') AS Title, coalesce(j->>'$.Deck', 'Unknown') AS Deck FROM parsed),
requested AS (SELECT id, CAST(Pclass AS DOUBLE) AS Pclass, Age, SibSp, Parch, Fare, Sex, Embarked, Title, Deck,
  coalesce(e, CASE WHEN Pclass IS NULL OR Fare IS NULL THEN 'unreadable: ' ||
   concat_ws(', ', CASE WHEN Pclass IS NULL THEN 'Pclass' END, CASE WHEN Fare IS NULL THEN 'Fare' END) END) AS error,
  SibSp + Parch + 1 AS FamilySize, CASE WHEN SibSp + Parch = 0 THEN 1 ELSE 0 END AS IsAlone,
  CASE WHEN Deck = 'Unknown' THEN 0 ELSE 1 END AS HasCabin FROM typed)
"""


@query("request_defaults", DEFAULTED + "SELECT * FROM requested")
def _(spark, sf):
    out = request_defaults(json_request_decode(view(spark, sf, "requests"))).drop("body")
    return out.withColumn("Pclass", F.col("Pclass").cast("double"))


@query("json_response_encode", with_views("passengers", """
scored AS (SELECT PassengerId AS id, Pclass / 3.0::DOUBLE * 0.9 AS p FROM passengers)
SELECT id, concat('{"prediction":', CASE WHEN p > 0.5 THEN 1 ELSE 0 END, ',"survived":',
 CASE WHEN p > 0.5 THEN 'true' ELSE 'false' END, ',"probability":', round_even(p, 4), '}') AS response FROM scored"""))
def _(spark, sf):
    p = F.col("Pclass") / 3 * 0.9
    return view(spark, sf, "passengers").select(
        F.col("PassengerId").alias("id"),
        json_response_encode((p > 0.5).cast("int"), p).alias("response"),
    )


@query("id_aligned_scores", with_views("passengers", """
SELECT PassengerId, CASE WHEN Sex = 'female' THEN 1 ELSE 0 END AS Survived FROM passengers"""))
def _(spark, sf):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    rule = PipelineModel([SQLTransformer(
        statement="SELECT *, CAST(Sex = 'female' AS DOUBLE) AS prediction FROM __THIS__")])
    return models.id_aligned_scores(rule.transform(view(spark, sf, "passengers")), "PassengerId")


# --- models ------------------------------------------------------------------
# Every fit runs at the full setting. SQL restates which rows come out; the columns of
# checks are computed from the fitted models and must all hold.

def _kept(df: DataFrame, name: str, build) -> DataFrame:
    """A table made from exactly the rows of ``df``, written once for an application. Its
    path carries a digest of the rows, so other rows are never answered from it, and a
    cleared scratch folder has it built again."""
    h = F.xxhash64(*df.columns)
    rows = df.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40)))).first()
    spark = df.sparkSession
    return tables.stage_cache(spark, named_path(spark, "-".join(map(str, (name, *rows)))), build)


def _fitted(spark, sf, name: str):
    """Training rows and a model fitted on them now."""
    df = training(spark, sf)
    return df, models.fit_model(df, models.candidate_models()[name])


def _consistent() -> Column:
    """The prediction is the likelier class of a probability."""
    p = F.col("probability")
    return p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("int"))


def _scored(df: DataFrame, model) -> DataFrame:
    out = stage_table(models.batch_score(model, df, ["PassengerId", LABEL]), "scored")
    right = out.agg(
        (F.avg((F.col("prediction") == F.col(LABEL)).cast("int"))
         >= F.greatest(F.avg(LABEL), 1 - F.avg(LABEL))).alias("no_worse_than_majority")
    )
    return out.withColumn("consistent", _consistent()).crossJoin(right).drop("prediction", "probability")


CHECKED = survival.ENGINEERED + """
SELECT PassengerId, Survived, TRUE AS consistent, TRUE AS no_worse_than_majority"""


@query("logistic_regression", CHECKED + ", TRUE AS at_optimum FROM engineered")
def _(spark, sf):
    """At the optimum every slot's gradient of the ridge objective is about zero."""
    df, model = _fitted(spark, sf, "LogisticRegression")
    slope = models.ridge_gradient(model, df, LABEL)
    return _scored(df, model).withColumn("at_optimum", F.lit(slope < 1e-3))


@query("random_forest", CHECKED + f", CAST({K.FOREST_TREES} AS INT) AS trees FROM engineered")
def _(spark, sf):
    df, model = _fitted(spark, sf, "RandomForest")
    return _scored(df, model).withColumn("trees", F.lit(len(model.stages[-1].trees)))


@query("gradient_boosting", CHECKED + f", CAST({K.BOOST_ROUNDS} AS INT) AS trees FROM engineered")
def _(spark, sf):
    df, model = _fitted(spark, sf, "GradientBoosting")
    return _scored(df, model).withColumn("trees", F.lit(len(model.stages[-1].trees)))


def _judged(spark, sf) -> DataFrame:
    """Every row judged by each full model, fitted without its fold."""
    df = training(spark, sf)
    folded = sampling.stratified_kfold(df, LABEL, "PassengerId")
    return _kept(
        df, "judged", lambda: models.cv_predictions(folded, ["PassengerId", LABEL], LABEL, parallelism=8)
    )


def _comparison(spark, sf) -> DataFrame:
    """Accuracy of each full model on each of the five folds."""
    return models.fold_scores(_judged(spark, sf), LABEL)


@query("cv_compare", survival.FOLDED + """
SELECT m.model, f.fold, count(*) AS held, TRUE AS valid FROM folded f, (
 VALUES ('LogisticRegression'), ('RandomForest'), ('GradientBoosting')) m(model) GROUP BY ALL""")
def cv_compare(spark, sf):
    held = survival.folded(spark, sf).groupBy("fold").agg(F.count("*").alias("held"))
    return _comparison(spark, sf).join(held, "fold").select(
        "model", "fold", "held", F.col("accuracy").between(0, 1).alias("valid")
    )


def _report(scored: DataFrame) -> DataFrame:
    report = evaluation.classification_report(scored, LABEL, "prediction", names=K.OUTCOME_NAMES)
    valid = F.forall(F.array("precision", "recall", "f1"), lambda x: x.between(0, 1))
    return report.select("class", "support", valid.alias("valid"))


REPORT = survival.ENGINEERED + f"""
, named AS (SELECT CASE Survived WHEN 0 THEN '{K.OUTCOME_NAMES[0]}' ELSE '{K.OUTCOME_NAMES[1]}' END AS class
 FROM engineered)
SELECT class, count(*) AS support, TRUE AS valid FROM named GROUP BY class
UNION ALL SELECT a, (SELECT count(*) FROM named), TRUE FROM (
 VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(a)"""


@query("refit_best", REPORT)
def refit_best(spark, sf):
    """Report of the winner of the comparison, refitted on all rows."""
    best = models.winner(_comparison(spark, sf))
    data, model = _fitted(spark, sf, best)
    return _report(models.batch_score(model, data, [LABEL]))


def _out_of_fold(spark, sf) -> DataFrame:
    """Every row judged by the winner of the comparison: its fits of the comparison did not
    see the row's fold either, so nothing is fitted again."""
    judged = _judged(spark, sf)
    return judged.where(F.col("model") == models.winner(models.fold_scores(judged, LABEL)))


@query("oof_predictions", survival.FOLDED + """
SELECT PassengerId, Survived, fold, TRUE AS consistent FROM folded""")
def _(spark, sf):
    return _out_of_fold(spark, sf).select(
        "PassengerId", LABEL, "fold", _consistent().alias("consistent")
    )


@query("oof_report", REPORT)
def _(spark, sf):
    """The honest report: every row judged by the winner fitted without its fold."""
    return _report(_out_of_fold(spark, sf))


@query("training_run", survival.ENGINEERED + """
SELECT PassengerId, TRUE AS valid FROM engineered""")
def _(spark, sf):
    """From a CSV to a submission CSV: read, engineer, compare, refit the winner, save it,
    load it, score and write."""
    path, saved, out = (scratch_path(spark, n) for n in ("train", "winner", "submission"))
    view(spark, sf, "passengers").write.option("header", True).option("escape", '"').csv(path)
    rows = engineer_features(tables.csv_scan(spark, path, survival.CSV_SCHEMA))
    columns = ["PassengerId", LABEL, *K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES]
    best = models.winner(_comparison(spark, sf))
    model = models.fit_model(rows.select(*columns), models.candidate_models()[best])
    tables.save_model(model, saved)
    scored = models.batch_score(tables.load_model(spark, saved), rows, ["PassengerId"])
    named = models.id_aligned_scores(scored, "PassengerId", LABEL)
    tables.csv_sink(named, out, "PassengerId", LABEL)
    done = tables.csv_scan(spark, out, f"PassengerId INT, {LABEL} INT")
    return done.select("PassengerId", F.col(LABEL).isin(0, 1).alias("valid"))


@query("batch_score", DEFAULTED + "SELECT id, TRUE AS consistent FROM requested WHERE error IS NULL")
def _(spark, sf):
    """A model fitted on passengers, applied to scoring requests."""
    _, model = _fitted(spark, sf, "LogisticRegression")
    requests = view(spark, sf, "requests")
    requests = models.spread(requests, requests.count())
    rows = request_defaults(json_request_decode(requests)).where("error IS NULL")
    return models.batch_score(model, rows, ["id"]).select("id", _consistent().alias("consistent"))


@query("stream_score", DEFAULTED + """
SELECT id, error, TRUE AS same_as_batch, error IS NULL AS answered FROM requested""")
def _(spark, sf):
    _, model = _fitted(spark, sf, "LogisticRegression")
    path = f"{sf}/customer.parquet"
    schema = spark.read.parquet(path).schema
    spark.readStream.schema(schema).parquet(f"{path}*").createOrReplaceTempView("arriving_customers")
    arriving = spark.sql(REQUESTS.replace("{customer}", "arriving_customers"))
    answers = score_requests(arriving, model, ["id"])
    out = scratch_path(spark, "answers")
    run_to_files(answers, out, scratch_path(spark, "answers-state"))
    streamed = spark.read.schema(answers.schema).parquet(out)
    batch = score_requests(view(spark, sf, "requests"), model, ["id"]).select(
        F.col("id").alias("of"), F.col("response").alias("expected")
    )
    return streamed.join(batch, F.col("id") == F.col("of"), "left").select(
        "id", "error", F.col("response").eqNullSafe(F.col("expected")).alias("same_as_batch"),
        F.col("response").isNotNull().alias("answered"),
    )


@query("feature_importance", PREPROCESSED_NAMES + """
SELECT DISTINCT regexp_replace(name, '^(num|cat)__', '') AS feature, TRUE AS valid, TRUE AS sums_to_one
FROM names""")
def _(spark, sf):
    df, model = _fitted(spark, sf, "RandomForest")
    ranked = models.feature_importance(model, model.transform(df))
    whole = ranked.agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))
    return ranked.select("feature", F.col("importance").between(0, 1).alias("valid")).crossJoin(whole)


@query("model_store", survival.ENGINEERED + "SELECT PassengerId, TRUE AS same FROM engineered")
def _(spark, sf):
    """Predictions of a model that was saved and loaded again, beside its own."""
    df, model = _fitted(spark, sf, "LogisticRegression")
    path = scratch_path(spark, "model")
    tables.save_model(model, path)
    loaded = models.batch_score(tables.load_model(spark, path), df, ["PassengerId"])
    own = models.batch_score(model, df, ["PassengerId"]).toDF("of", "own", "own_p")
    same = (F.col("prediction") == F.col("own")) & (F.col("probability") == F.col("own_p"))
    return loaded.join(own, F.col("PassengerId") == F.col("of")).select("PassengerId", same.alias("same"))


def _learned(scored: DataFrame, label: str) -> bool:
    """Right at least as often, on the rows of the fit, as the most frequent label."""
    sizes = scored.groupBy(label).agg(
        F.count("*").alias("n"), F.count_if(F.col(label).cast("string") == F.col("predicted")).alias("r")
    )
    return sizes.agg(F.sum("r") >= F.max("n")).first()[0]


def _landmark_model(spark, sf):
    table_ = landmark_jobs.landmark_training_table(
        view(spark, sf, "landmarks"), "vec_id", "points", "letter", "handedness"
    )
    data = stage_table(table_, "hands", partition_by="split")
    return data, models.landmark_mlp(
        data.where("split = 'train'"), partitions=spark.sparkContext.defaultParallelism
    )


@query("landmark_mlp", SPLIT_HANDS + """
SELECT vec_id, letter, TRUE AS named, TRUE AS learned FROM parted WHERE split = 'test'""")
def _(spark, sf):
    """Held-out hands and their letters from the landmark perceptron."""
    data, model = _landmark_model(spark, sf)
    learned = _learned(models.apply_perceptron(model, data.where("split = 'train'")), "letter")
    held = models.apply_perceptron(model, data.where("split = 'test'"))
    return held.select(
        "vec_id", "letter", F.col("predicted").isin(list(K.ALPHABET)).alias("named"),
        F.lit(learned).alias("learned"),
    )


@query("landmark_record", SPLIT_HANDS + """
SELECT vec_id, CAST(3 AS INT) AS n_top, TRUE AS best_is_first, TRUE AS ordered, TRUE AS labelled
FROM parted WHERE split = 'test'""")
def _(spark, sf):
    """Answer record and best three classes from the fitted landmark model."""
    data, model = _landmark_model(spark, sf)
    out = models.perceptron_record(model, data.where("split = 'test'"), ["vec_id"])
    sure = F.transform("top", lambda t: t["confidence"])
    return out.select(
        "vec_id", F.size("top").alias("n_top"),
        (F.col("top")[0]["confidence"] == F.col("confidence")).alias("best_is_first"),
        (sure == F.sort_array(sure, asc=False)).alias("ordered"),
        (F.col("label") == F.ascii("letter") - 65).alias("labelled"),
    )


@query("pixel_classifier", SPLIT_PIXELS + """
SELECT vec_id, label, TRUE AS named, TRUE AS learned FROM parted WHERE split = 'test'""")
def _(spark, sf):
    """Held-out images and their classes; fitted on the other side of the split."""
    rows = sampling.stratified_split(view(spark, sf, "pixels"), "label", "vec_id")
    data = stage_table(rows, "pixels", partition_by="split")
    model = models.pixel_classifier(
        data.where("split = 'train'"), partitions=spark.sparkContext.defaultParallelism
    )
    scored = model.transform(models.pixel_vectors(data))
    learned = _learned(scored.where("split = 'train'"), "label")
    return scored.where("split = 'test'").select(
        "vec_id", "label", F.col("predicted").cast("int").between(0, 25).alias("named"),
        F.lit(learned).alias("learned"),
    )

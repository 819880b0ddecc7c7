"""Queries over the passenger views: features, profiling, evaluation, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions import passenger as P
from tabulark.operators import cleaning, evaluation, preprocess, profile, sampling
from tabulark.plans.fixtures import view, with_views
from tabulark.plans.registry import query
from tabulark.session import scratch_path, session_cache
from tabulark.sources import tables

RARE = ", ".join(f"'{t}'" for t in K.RARE_TITLES)
ENGINEERED = with_views(
    "passengers",
    rf"""
titled AS (SELECT *, CASE WHEN regexp_matches(Name, ',\s*[^.]+\.')
   THEN trim(regexp_extract(Name, ',\s*([^.]+)\.', 1)) END AS RawTitle FROM passengers),
engineered AS (SELECT *,
  CASE WHEN RawTitle IN ({RARE}) THEN 'Rare' WHEN RawTitle IN ('Mlle', 'Ms') THEN 'Miss'
       WHEN RawTitle = 'Mme' THEN 'Mrs' ELSE RawTitle END AS Title,
  SibSp + Parch + 1 AS FamilySize,
  CASE WHEN SibSp + Parch + 1 = 1 THEN 1 ELSE 0 END AS IsAlone,
  coalesce(nullif(substr(Cabin, 1, 1), ''), 'Unknown') AS Deck,
  CASE WHEN Cabin IS NULL THEN 0 ELSE 1 END AS HasCabin
 FROM titled) """,
)


def engineered(spark, sf_dir):
    return P.engineer_features(view(spark, sf_dir, "passengers"))


def passengers(spark, sf_dir):
    return view(spark, sf_dir, "passengers")


# --- features ----------------------------------------------------------------

@query("title_extract", ENGINEERED + "SELECT PassengerId, RawTitle AS title FROM titled")
def _(spark, sf):
    return passengers(spark, sf).select(
        "PassengerId", P.title_extract(F.col("Name")).alias("title")
    )


@query("title_group", ENGINEERED + "SELECT PassengerId, Title AS title FROM engineered")
def _(spark, sf):
    title = P.title_group(P.title_extract(F.col("Name")))
    return passengers(spark, sf).select("PassengerId", title.alias("title"))


@query("family_size", ENGINEERED + "SELECT PassengerId, FamilySize AS family_size FROM engineered")
def _(spark, sf):
    size = P.family_size(F.col("SibSp"), F.col("Parch"))
    return passengers(spark, sf).select("PassengerId", size.alias("family_size"))


@query("is_alone", ENGINEERED + "SELECT PassengerId, IsAlone AS is_alone FROM engineered")
def _(spark, sf):
    size = P.family_size(F.col("SibSp"), F.col("Parch"))
    return passengers(spark, sf).select("PassengerId", P.is_alone(size).alias("is_alone"))


@query("deck_letter", ENGINEERED + "SELECT PassengerId, Deck AS deck FROM engineered")
def _(spark, sf):
    return passengers(spark, sf).select("PassengerId", P.deck_letter(F.col("Cabin")).alias("deck"))


@query("has_value_flag", ENGINEERED + "SELECT PassengerId, HasCabin AS has_cabin FROM engineered")
def _(spark, sf):
    return passengers(spark, sf).select(
        "PassengerId", P.has_value_flag(F.col("Cabin")).alias("has_cabin")
    )


@query("engineer_features", ENGINEERED + "SELECT * EXCLUDE (RawTitle) FROM engineered")
def _(spark, sf):
    return engineered(spark, sf)


FEATURES = ", ".join(K.NUMERIC_FEATURES + K.CATEGORICAL_FEATURES)


@query("feature_select", ENGINEERED + f"SELECT PassengerId, {FEATURES} FROM engineered")
def _(spark, sf):
    return P.feature_select(engineered(spark, sf), ["PassengerId"])


@query(
    "drop_missing",
    with_views("passengers", """
SELECT 'Age' AS scope, PassengerId FROM passengers WHERE Age IS NOT NULL
UNION ALL
SELECT 'any', PassengerId FROM passengers WHERE Age IS NOT NULL AND SibSp IS NOT NULL
 AND Fare IS NOT NULL AND Cabin IS NOT NULL AND Embarked IS NOT NULL"""),
)
def _(spark, sf):
    df = passengers(spark, sf)
    one = cleaning.drop_missing(df, ["Age"]).select(F.lit("Age").alias("scope"), "PassengerId")
    return one.unionByName(
        cleaning.drop_missing(df).select(F.lit("any").alias("scope"), "PassengerId")
    )


@query("value_map", with_views("passengers", """
SELECT PassengerId, CASE Survived WHEN 0 THEN 'Died' WHEN 1 THEN 'Survived' END AS outcome
FROM passengers"""))
def _(spark, sf):
    return passengers(spark, sf).select(
        "PassengerId", P.value_map(F.col("Survived"), K.OUTCOME_NAMES).alias("outcome")
    )


@query("strip_prefix", ENGINEERED + """
, names AS (SELECT DISTINCT 'cat__Title_' || Title AS n FROM engineered WHERE Title IS NOT NULL
 UNION SELECT DISTINCT 'num__Deck_' || Deck FROM engineered)
SELECT n AS name, substr(n, 6) AS feature FROM names""")
def _(spark, sf):
    df = engineered(spark, sf)
    names = F.explode(F.array(F.concat(F.lit("cat__Title_"), "Title"), F.concat(F.lit("num__Deck_"), "Deck")))
    listed = df.select(names.alias("name")).where("name IS NOT NULL").distinct()
    return listed.withColumn("feature", P.strip_prefix(F.col("name")))


@query("percent_round", with_views("passengers", """
SELECT Pclass, round_even(avg(Survived) * 100, 1) AS percent FROM passengers GROUP BY Pclass"""))
def _(spark, sf):
    return passengers(spark, sf).groupBy("Pclass").agg(
        P.percent_round(F.avg("Survived")).alias("percent")
    )


# --- profiling ---------------------------------------------------------------

PASSENGER_COLUMNS = [
    "PassengerId", "Survived", "Pclass", "Name", "Sex", "Age", "SibSp", "Parch", "Fare", "Cabin",
    "Embarked",
]


@query("table_shape", with_views("passengers", """
SELECT count(*) AS n_rows, CAST(11 AS INT) AS n_columns FROM passengers"""))
def _(spark, sf):
    return profile.table_shape(passengers(spark, sf))


@query("schema_info", with_views("passengers", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, '{t}' AS dtype FROM passengers"
    for c, t in zip(PASSENGER_COLUMNS, [
        "bigint", "int", "int", "string", "string", "double", "double", "bigint", "double",
        "string", "string"]))))
def _(spark, sf):
    return profile.schema_info(passengers(spark, sf))


DESCRIBED = ["Age", "Fare", "SibSp", "Parch"]


@query("describe_numeric", with_views("passengers", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
 round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
 round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
 round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
 round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max
FROM passengers""" for c in DESCRIBED)))
def _(spark, sf):
    out = profile.describe_numeric(passengers(spark, sf), DESCRIBED)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("missing_profile", with_views("passengers", "SELECT * FROM (" + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
 round_even((count(*) - count({c})) / count(*) * 100, 1) AS percent FROM passengers"""
    for c in PASSENGER_COLUMNS) + ") WHERE missing > 0"))
def _(spark, sf):
    return profile.missing_profile(passengers(spark, sf))


@query("missing_total", with_views("passengers", "SELECT CAST(" + " + ".join(
    f"count(*) - count({c})" for c in PASSENGER_COLUMNS) + " AS BIGINT) AS missing FROM passengers"))
def _(spark, sf):
    return profile.missing_total(passengers(spark, sf))


@query("target_rate", with_views("passengers", "SELECT round(avg(Survived), 6) AS rate FROM passengers"))
def _(spark, sf):
    return profile.target_rate(passengers(spark, sf), "Survived").select(F.round("rate", 6).alias("rate"))


@query("value_counts", with_views("passengers", """
SELECT Embarked, count(*) AS count FROM passengers WHERE Embarked IS NOT NULL GROUP BY Embarked"""))
def _(spark, sf):
    return profile.value_counts(passengers(spark, sf), "Embarked")


RATED = ["Sex", "Pclass", "Title", "FamilySize"]
GROUP_RATE = ENGINEERED + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, round_even(avg(Survived) * 100, 1) AS rate
FROM engineered WHERE {c} IS NOT NULL GROUP BY {c}""" for c in RATED)


@query("group_rate", GROUP_RATE)
def group_rate(spark, sf):
    return profile.group_rate(engineered(spark, sf), RATED, "Survived")


@query("distinct_count", with_views("passengers", """
SELECT count(DISTINCT Embarked) AS n_distinct FROM passengers"""))
def _(spark, sf):
    return profile.distinct_count(passengers(spark, sf), "Embarked")


@query("histogram_equal", with_views("passengers", """
ends AS (SELECT Survived, min(Age) AS lo, max(Age) AS hi FROM passengers WHERE Age IS NOT NULL GROUP BY Survived),
bins AS (SELECT Survived, i AS bin, lo + i * ((hi - lo) / 30) AS low,
  CASE WHEN i = 29 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 30) END AS high FROM ends, range(0, 30) r(i))
SELECT b.Survived, CAST(b.bin AS INT) AS bin, round(b.low, 6) AS low, round(b.high, 6) AS high,
 count(p.PassengerId) AS count
FROM bins b LEFT JOIN passengers p ON p.Survived = b.Survived AND p.Age >= b.low
 AND (p.Age < b.high OR b.bin = 29 AND p.Age = b.high)
GROUP BY ALL"""))
def _(spark, sf):
    out = profile.histogram_equal(passengers(spark, sf), "Age", 30, "Survived")
    return out.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("histogram_nice", with_views("passengers", """
ends AS (SELECT min(Age) AS lo, max(Age) AS hi FROM passengers),
width AS (SELECT min(w) AS w FROM (SELECT d * pow(10, k) AS w FROM range(-3, 6) r(k),
  (VALUES (1), (2), (5)) v(d)), ends WHERE (hi - lo) / w <= 30)
SELECT CASE Survived WHEN 0 THEN 'Died' ELSE 'Survived' END AS outcome,
 floor(Age / w) * w AS low, floor(Age / w) * w + w AS high, count(*) AS count
FROM passengers, width WHERE Age IS NOT NULL GROUP BY ALL"""))
def _(spark, sf):
    outcome = P.value_map(F.col("Survived"), K.OUTCOME_NAMES)
    return profile.histogram_nice(passengers(spark, sf), "Age", outcome)


# --- evaluation --------------------------------------------------------------

@query("confusion_matrix", with_views("predictions", """
grid AS (SELECT a.v AS actual, b.v AS predicted FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v))
SELECT CAST(g.actual AS INT) AS actual, CAST(g.predicted AS INT) AS predicted, count(p.doc_id) AS count
FROM grid g LEFT JOIN predictions p ON p.actual = g.actual AND p.predicted = g.predicted
GROUP BY ALL"""))
def _(spark, sf):
    return evaluation.confusion_matrix(view(spark, sf, "predictions"), "actual", "predicted")


@query("confusion_long", with_views("predictions", """
SELECT a.n AS actual, b.n AS predicted,
 (SELECT count(*) FROM predictions p WHERE p.actual = a.v AND p.predicted = b.v) AS count
FROM (VALUES (0, 'Died'), (1, 'Survived')) a(v, n), (VALUES (0, 'Died'), (1, 'Survived')) b(v, n)"""))
def _(spark, sf):
    wide = evaluation.confusion_wide(view(spark, sf, "predictions"), "actual", "predicted", [0, 1])
    return evaluation.confusion_long(wide, K.OUTCOME_NAMES)


@query("binary_metrics", with_views("predictions", """
c AS (SELECT count(*) AS n, count(*) FILTER (actual = predicted) AS ok,
  count(*) FILTER (actual = 1 AND predicted = 1) AS tp, count(*) FILTER (predicted = 1) AS pp,
  count(*) FILTER (actual = 1) AS ap FROM predictions)
SELECT round(ok / n, 6) AS accuracy, round(tp / pp, 6) AS precision, round(tp / ap, 6) AS recall,
 round(2 * tp / (pp + ap), 6) AS f1 FROM c"""))
def _(spark, sf):
    out = evaluation.binary_metrics(view(spark, sf, "predictions"), "actual", "predicted")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def report_sql(source: str, views: str) -> str:
    """Classification report over columns actual and predicted of ``source``."""
    return with_views(views, f"""
labs AS (SELECT actual AS l FROM {source} UNION SELECT predicted FROM {source}),
per AS (SELECT l, (SELECT count(*) FROM {source} WHERE actual = l AND predicted = l) AS tp,
  (SELECT count(*) FROM {source} WHERE predicted = l) AS pp,
  (SELECT count(*) FROM {source} WHERE actual = l) AS ap FROM labs),
rated AS (SELECT l, ap, tp, coalesce(tp / nullif(pp, 0), 0) AS p, coalesce(tp / nullif(ap, 0), 0) AS r,
  coalesce(2 * tp / nullif(pp + ap, 0), 0) AS f FROM per)
SELECT CAST(l AS VARCHAR) AS class, round_even(p, 3) AS precision, round_even(r, 3) AS recall,
 round_even(f, 3) AS f1, ap AS support FROM rated
UNION ALL SELECT 'accuracy', round_even(sum(tp) / sum(ap), 3), round_even(sum(tp) / sum(ap), 3),
 round_even(sum(tp) / sum(ap), 3), CAST(sum(ap) AS BIGINT) FROM rated
UNION ALL SELECT 'macro avg', round_even(avg(p), 3), round_even(avg(r), 3), round_even(avg(f), 3),
 CAST(sum(ap) AS BIGINT) FROM rated
UNION ALL SELECT 'weighted avg', round_even(sum(p * ap) / sum(ap), 3), round_even(sum(r * ap) / sum(ap), 3),
 round_even(sum(f * ap) / sum(ap), 3), CAST(sum(ap) AS BIGINT) FROM rated""")


@query("classification_report", report_sql("predictions", "predictions"))
def _(spark, sf):
    return evaluation.classification_report(view(spark, sf, "predictions"), "actual", "predicted")


@query("holdout_eval", report_sql("predictions_multi", "predictions_multi"))
def _(spark, sf):
    return evaluation.classification_report(
        view(spark, sf, "predictions_multi"), "actual", "predicted"
    )


# --- fitted statistics -------------------------------------------------------

FITTED = ["Age", "Fare", "SibSp", "Parch"]


@query("fit_median", with_views("passengers", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(median(CAST({c} AS DOUBLE)), 6) AS median FROM passengers"
    for c in FITTED)))
def _(spark, sf):
    return preprocess.fit_median(passengers(spark, sf), FITTED).withColumn("median", F.round("median", 6))


MODE_SQL = ENGINEERED + """
, long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM engineered"
    for c in K.CATEGORICAL_FEATURES) + """),
counted AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)
"""


@query("fit_mode", MODE_SQL + """
SELECT "column", value AS mode FROM counted
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""")
def _(spark, sf):
    return preprocess.fit_mode(engineered(spark, sf), K.CATEGORICAL_FEATURES)


@query("fit_scale", with_views("passengers", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM passengers"
    for c in FITTED)))
def _(spark, sf):
    out = preprocess.fit_scale(passengers(spark, sf), FITTED)
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("fit_vocab", MODE_SQL + """
SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INT) AS place
FROM counted""")
def _(spark, sf):
    return preprocess.fit_vocab(engineered(spark, sf), K.CATEGORICAL_FEATURES)


# --- ordering, sampling, splitting -------------------------------------------

@query("head_n", with_views("passengers", "SELECT * FROM passengers ORDER BY PassengerId LIMIT 10"))
def _(spark, sf):
    return sampling.head_n(passengers(spark, sf), 10, ["PassengerId"])


@query("top_k", with_views("passengers", """
SELECT PassengerId, Fare FROM passengers WHERE Fare IS NOT NULL ORDER BY Fare DESC, PassengerId LIMIT 12"""))
def _(spark, sf):
    return sampling.top_k(
        passengers(spark, sf).select("PassengerId", "Fare").where("Fare IS NOT NULL"), "Fare", 12, "PassengerId"
    )


@query("sort_by_key", with_views("passengers", """
SELECT Embarked, count(*) AS count FROM passengers WHERE Embarked IS NOT NULL GROUP BY Embarked ORDER BY Embarked"""))
def _(spark, sf):
    return sampling.sort_by_key(profile.value_counts(passengers(spark, sf), "Embarked"), "Embarked")


@query("sort_by_value", with_views("passengers", """
SELECT Embarked, count(*) AS count FROM passengers WHERE Embarked IS NOT NULL GROUP BY Embarked ORDER BY 2"""))
def _(spark, sf):
    return sampling.sort_by_value(profile.value_counts(passengers(spark, sf), "Embarked"), "count", "Embarked")


@query("first_per_group", with_views("passengers", """
SELECT * FROM passengers QUALIFY row_number() OVER (PARTITION BY Embarked ORDER BY PassengerId) = 1"""))
def _(spark, sf):
    return sampling.first_per_group(passengers(spark, sf), "Embarked", "PassengerId")


@query("first_n_per_group", with_views("passengers", """
SELECT * FROM passengers QUALIFY row_number() OVER (PARTITION BY Embarked ORDER BY PassengerId) <= 5"""))
def _(spark, sf):
    return sampling.first_n_per_group(passengers(spark, sf), "Embarked", ["PassengerId"], 5)


@query("sample_n", with_views("passengers", """
SELECT * FROM passengers ORDER BY md5(concat('0-', PassengerId)), PassengerId LIMIT 12"""))
def _(spark, sf):
    return sampling.sample_n(passengers(spark, sf), 12, "PassengerId", 0)


@query("sample_one_per_key", with_views("passengers", """
SELECT * FROM passengers QUALIFY row_number() OVER (
 PARTITION BY Pclass ORDER BY md5(concat('0-', Pclass, '-', PassengerId)), PassengerId) = 1"""))
def _(spark, sf):
    return sampling.sample_one_per_key(passengers(spark, sf), "Pclass", "PassengerId", 0)


FOLDED = with_views("passengers", """
folded AS (SELECT *, CAST(((SELECT count(*) FROM passengers q WHERE q.Survived < p.Survived)
   + row_number() OVER (PARTITION BY Survived ORDER BY md5(concat('42-', PassengerId)), PassengerId) - 1) % 5 AS INT) AS fold
 FROM passengers p) """)


def folded(spark, sf):
    return sampling.stratified_kfold(engineered(spark, sf), "Survived", "PassengerId")


@query("stratified_kfold", FOLDED + "SELECT PassengerId, Survived, fold FROM folded")
def _(spark, sf):
    return folded(spark, sf).select("PassengerId", "Survived", "fold")


SCORED_FOLDS = FOLDED + """
, calls AS (SELECT fold, Survived, 'always_died' AS model, 0 AS call FROM folded
 UNION ALL SELECT fold, Survived, 'by_sex', CASE WHEN Sex = 'female' THEN 1 ELSE 0 END FROM folded),
scored AS (SELECT model, fold, avg(CASE WHEN Survived = call THEN 1.0 ELSE 0.0 END) AS score
 FROM calls GROUP BY ALL),
summary AS (SELECT model, round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score
 FROM scored GROUP BY model)
"""


def _fold_scores(spark, sf):
    """Accuracy per fold of two fixed rules."""
    rules = F.array(
        F.struct(F.lit("always_died").alias("model"), F.lit(0).alias("call")),
        F.struct(F.lit("by_sex").alias("model"), (F.col("Sex") == "female").cast("int").alias("call")),
    )
    calls = folded(spark, sf).select("fold", "Survived", F.explode(rules).alias("r"))
    right = (F.col("Survived") == F.col("r.call")).cast("double")
    return calls.groupBy(F.col("r.model").alias("model"), "fold").agg(F.avg(right).alias("score"))


def _summary(spark, sf):
    out = profile.score_summary(_fold_scores(spark, sf), "model", "score")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_score", "std_score")})


@query("score_summary", SCORED_FOLDS + "SELECT * FROM summary")
def _(spark, sf):
    return _summary(spark, sf)


@query("best_model", SCORED_FOLDS + "SELECT * FROM summary ORDER BY mean_score DESC, model LIMIT 1")
def _(spark, sf):
    return sampling.best_model(_summary(spark, sf), ["always_died", "by_sex"], "model", "mean_score")


@query("min_rows_guard", with_views("passengers", "SELECT count(*) AS n FROM passengers"))
def _(spark, sf):
    return cleaning.min_rows_guard(passengers(spark, sf)).agg(F.count(F.lit(1)).alias("n"))


@query("session_cache", ENGINEERED + """
SELECT 'sex' AS kind, Sex AS value, count(*) AS count FROM engineered GROUP BY Sex
UNION ALL SELECT 'title', Title, count(*) FROM engineered WHERE Title IS NOT NULL GROUP BY Title""")
def _(spark, sf):
    """Two small summaries from one cached table."""
    with session_cache(engineered(spark, sf)) as kept:
        parts = [
            profile.value_counts(kept, c).select(F.lit(k).alias("kind"), F.col(c).alias("value"), "count")
            for k, c in (("sex", "Sex"), ("title", "Title"))
        ]
    return parts[0].unionByName(parts[1])


# --- whole documents ---------------------------------------------------------

@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def _(spark, sf):
    return cleaning.dedup_rows(spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang"))


@query("duplicate_count", """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS BIGINT)
 AS duplicates FROM documents""")
def _(spark, sf):
    return profile.duplicate_count(spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang"))


# --- files -------------------------------------------------------------------

CSV_SCHEMA = (
    "PassengerId BIGINT, Survived INT, Pclass INT, Name STRING, Sex STRING, Age DOUBLE, "
    "SibSp DOUBLE, Parch BIGINT, Fare DOUBLE, Cabin STRING, Embarked STRING"
)


@query("csv_scan", with_views("passengers", """
SELECT * REPLACE (concat(Name, ' "Ann", B') AS Name) FROM passengers"""))
def _(spark, sf):
    path = scratch_path(spark, "csv")
    quoted = F.concat("Name", F.lit(' "Ann", B'))
    passengers(spark, sf).withColumn("Name", quoted).write.option("header", True).option(
        "escape", '"').csv(path)
    return tables.csv_scan(spark, path, CSV_SCHEMA)


@query("csv_sink", with_views("passengers", """
SELECT PassengerId, CASE WHEN Sex = 'female' THEN 1 ELSE 0 END AS Survived FROM passengers"""))
def _(spark, sf):
    path = scratch_path(spark, "submission")
    scored = passengers(spark, sf).select(
        "PassengerId", (F.col("Sex") == "female").cast("double").alias("Survived")
    )
    tables.csv_sink(scored, path, "PassengerId", "Survived")
    return tables.csv_scan(spark, path, "PassengerId BIGINT, Survived INT")


@query("stage_cache", ENGINEERED + "SELECT PassengerId, Title, FamilySize FROM engineered")
def _(spark, sf):
    path = scratch_path(spark, "features")
    build = lambda: engineered(spark, sf).select("PassengerId", "Title", "FamilySize")
    tables.stage_cache(spark, path, build)
    return tables.stage_cache(spark, path, build)

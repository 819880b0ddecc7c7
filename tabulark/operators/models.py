"""Model comparison, out-of-fold prediction, refit, scoring and importances."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StringIndexer, IndexToString
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.passenger import strip_prefix
from tabulark.functions.letters import argmax_prediction, topk_classes
from tabulark.functions.pixels import pixel_scale
from tabulark.operators.forest import BinnedBoosting, BinnedForest, binned_rows, binning
from tabulark.operators.perceptron import fit_weights
from tabulark.operators.preprocess import TabularPreprocessor, feature_names
from tabulark.operators.sampling import best_model
from tabulark.session import session_cache, stage_table

ModelMaker = Callable[[int], Estimator]

TASK_ROWS = 100_000
LEAST_ROWS = 5_000


def logistic_regression(rows: int, label: str = "Survived") -> Estimator:
    """Ridge penalty of strength 1 on the summed loss, i.e. 1/rows on the mean loss."""
    return LogisticRegression(
        labelCol=label, regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, maxIter=1000
    )


def random_forest(rows: int, label: str = "Survived", trees: int = K.FOREST_TREES) -> Estimator:
    return BinnedForest(
        labelCol=label, numTrees=trees, maxDepth=K.FOREST_DEPTH, minInstancesPerNode=K.FOREST_LEAF,
        featureSubsetStrategy="sqrt", seed=K.SEED,
    )


def gradient_boosting(rows: int, label: str = "Survived", rounds: int = K.BOOST_ROUNDS) -> Estimator:
    boosting = BinnedBoosting(
        labelCol=label, maxIter=rounds, stepSize=K.BOOST_STEP, maxDepth=K.BOOST_DEPTH, seed=K.SEED
    )
    return Pipeline(stages=[boosting])


def candidate_models(
    label: str = "Survived", trees: int = K.FOREST_TREES, rounds: int = K.BOOST_ROUNDS
) -> dict[str, ModelMaker]:
    """The compared models in order; each maker gets the number of training rows."""
    return {
        "LogisticRegression": lambda n: logistic_regression(n, label),
        "RandomForest": lambda n: random_forest(n, label, trees),
        "GradientBoosting": lambda n: gradient_boosting(n, label, rounds),
    }


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Rows dealt evenly to tasks of at most ``TASK_ROWS``, in whole rounds of the cores. A
    fit passes over its rows hundreds of times, and a small file is one task whatever it
    holds."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = math.ceil(rows / (cores * TASK_ROWS))
    return df.repartition(max(1, min(math.ceil(rows / LEAST_ROWS), cores * rounds)))


def fit_model(df: DataFrame, maker: ModelMaker, prepare: Estimator | None = None) -> PipelineModel:
    """Preprocessing and model fitted together on one training table."""
    rows = df.count()
    model = maker(rows)
    own = model.getStages() if isinstance(model, Pipeline) else [model]
    stages = [prepare if prepare is not None else TabularPreprocessor(), *own]
    with session_cache(spread(df, rows)) as dealt:
        return Pipeline(stages=stages).fit(dealt)


def _fold_numbers(df: DataFrame, fold: str) -> list[int]:
    return sorted(r[fold] for r in df.select(fold).distinct().collect())


def _side_by_side(work: Callable, jobs: Sequence, parallelism: int, spark) -> list:
    """Run driver-side fits concurrently; Spark schedules their tasks together."""
    pool = ThreadPool(processes=max(1, min(parallelism, len(jobs))))
    try:
        return pool.map(inheritable_thread_target(spark)(work), jobs)
    finally:
        pool.close()


def ridge_gradient(model: PipelineModel, df: DataFrame, label: str = "Survived") -> float:
    """Largest slope, over all slots and the intercept, of the mean loss plus half the
    penalty times the squared weights; about zero at the optimum."""
    last = model.stages[-1]
    scored = model.transform(df).select(
        (vector_to_array("probability")[1] - F.col(label)).alias("miss"),
        vector_to_array("features").alias("x"),
    )
    weights = last.coefficients.toArray()
    slopes = [F.avg(F.col("miss") * F.col("x")[i]) for i in range(len(weights))]
    row = scored.agg(F.avg("miss"), *slopes).first()
    penalty = last.getRegParam()
    return max(abs(row[0]), *[abs(s + penalty * w) for s, w in zip(row[1:], weights)])


def winner(scores: DataFrame) -> str:
    """Name of the model with the best mean accuracy over the folds."""
    means = scores.groupBy("model").agg(F.avg("accuracy").alias("score"))
    return best_model(means, list(candidate_models()), "model", "score").first()["model"]


def cv_predictions(
    df: DataFrame,
    keep: Sequence[str],
    label: str = "Survived",
    fold: str = "fold",
    models: Mapping[str, ModelMaker] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Every row scored by every model, fitted without the row's fold, preprocessing included:
    ``model``, the kept columns, the fold, prediction and probability. The rows are written
    once, partitioned by fold, so a fit reads only its folds; the models of trees share a
    fold's groups of equal binned rows, and the boostings of all folds go round by round."""
    models = models or candidate_models(label)
    spark = df.sparkSession

    kept = stage_table(df, "folds", partition_by=fold)
    folds = _fold_numbers(kept, fold)

    def tree_of(name, rows):
        """The tree estimator that a model consists of, if it is one."""
        own = models[name](rows)
        stages = own.getStages() if isinstance(own, Pipeline) else [own]
        grouped = len(stages) == 1 and isinstance(stages[0], (BinnedBoosting, BinnedForest))
        return stages[0] if grouped else None

    def shape(k):
        """The preprocessing of a fold and the groups of its rows, made once for all models."""
        seen = kept.where(F.col(fold) != k)
        rows = seen.count()
        prepared = TabularPreprocessor().fit(seen)
        shaped = spread(prepared.transform(seen).select(label, "features"), rows).persist()
        groups = {}
        for key in {binning(t) for t in (tree_of(m, rows) for m in models) if t is not None}:
            counted, cuts = binned_rows(shaped, *key)
            groups[key] = counted.persist(), cuts
        return shaped, rows, prepared, groups

    shaped = dict(zip(folds, _side_by_side(shape, folds, parallelism, spark)))
    one_forest = Lock()

    def fit(name, among):
        trees = [tree_of(name, shaped[k][1]) for k in among]
        if trees[0] is None:
            return [models[name](shaped[k][1]).fit(shaped[k][0]) for k in among]
        tables = [shaped[k][3][binning(t)] for k, t in zip(among, trees)]
        if isinstance(trees[0], BinnedBoosting):
            return trees[0].fit_together(tables)
        # a forest fills all cores
        with one_forest:
            return [t.fit_groups(*table) for t, table in zip(trees, tables)]

    def score(job):
        name, among = job
        parts = []
        for k, fitted in zip(among, fit(name, among)):
            model = PipelineModel([shaped[k][2], fitted])
            held = batch_score(model, kept.where(F.col(fold) == k), [*keep, fold])
            parts.append(stage_table(held.select(F.lit(name).alias("model"), "*"), "held"))
        return parts

    def together(name):
        return isinstance(tree_of(name, shaped[folds[0]][1]), BinnedBoosting)

    # the longest fits, the last models, begin first
    jobs = [
        (m, among) for m in reversed(list(models)) for among in ([folds] if together(m) else [[k] for k in folds])
    ]
    try:
        parts = sum(_side_by_side(score, jobs, parallelism, spark), [])
    finally:
        for seen, _, _, groups in shaped.values():
            seen.unpersist()
            for counted, _ in groups.values():
                counted.unpersist()
    return reduce(DataFrame.unionByName, parts)


def fold_scores(scored: DataFrame, label: str = "Survived", fold: str = "fold") -> DataFrame:
    """Accuracy of every model on every fold."""
    right = (F.col(label) == F.col("prediction")).cast("int")
    return scored.groupBy("model", F.col(fold).cast("int").alias("fold")).agg(F.avg(right).alias("accuracy"))


def cv_compare(
    df: DataFrame,
    label: str = "Survived",
    fold: str = "fold",
    models: Mapping[str, ModelMaker] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Accuracy of every model on every fold, preprocessing fitted inside the fold."""
    return fold_scores(cv_predictions(df, [label], label, fold, models, parallelism), label, fold)


def batch_score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Prediction and probability of the positive class, next to the kept columns."""
    return model.transform(df).select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


def oof_predictions(
    df: DataFrame,
    maker: ModelMaker,
    keep: Sequence[str],
    fold: str = "fold",
    parallelism: int = 4,
) -> DataFrame:
    """Every row scored by the model of the fold that did not see it."""
    kept = stage_table(df, "folds", partition_by=fold)
    folds = _fold_numbers(kept, fold)
    fitted = _side_by_side(
        lambda k: fit_model(kept.where(F.col(fold) != k), maker), folds, parallelism, df.sparkSession
    )
    parts = [
        batch_score(m, kept.where(F.col(fold) == k), [*keep, fold]) for k, m in zip(folds, fitted)
    ]
    return reduce(DataFrame.unionByName, parts)


def id_aligned_scores(scored: DataFrame, id_column: str, target: str = "Survived") -> DataFrame:
    """Submission table: the id came along through scoring, so nothing is re-joined."""
    return scored.select(id_column, F.col("prediction").cast("int").alias(target))


def feature_importance(model: PipelineModel, scored: DataFrame, features: str = "features") -> DataFrame:
    """Importance per feature name; linear models use absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    else:
        weights = abs(last.coefficients.toArray())
    rows = [(n, float(w)) for n, w in zip(feature_names(scored, features), weights)]
    table = scored.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.withColumn("feature", strip_prefix(F.col("feature")))


def _indexed_perceptron(
    df: DataFrame, label: str, features: str, hidden: Sequence[int], iterations: int, seed: int,
    partitions: int | None,
) -> PipelineModel:
    """Index the labels and fit. Training repeats over the rows many times, so a
    small table in few files gains from being spread over ``partitions`` first. The
    weights come from block products; Spark ML's model is made around them."""
    indexer = StringIndexer(
        inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"
    ).fit(df)
    width = len(df.select(features).first()[0])
    layers = [width, *hidden, len(indexer.labels)]
    rows = indexer.transform(df).select(features, "_label")
    weights = fit_weights(
        rows.repartition(partitions) if partitions else rows, features, "_label", layers, iterations, seed
    )
    net = MultilayerPerceptronClassifier(
        labelCol="_label", featuresCol=features, layers=layers, maxIter=0, seed=seed,
        initialWeights=Vectors.dense(weights),
    )
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    classifier = net.fit(rows.limit(1))
    classifier.set(classifier.maxIter, iterations)
    classifier.clear(classifier.initialWeights)
    return PipelineModel([classifier, names])


def landmark_mlp(
    df: DataFrame, label: str = "letter", vector: str = "features", iterations: int = K.PERCEPTRON_ITERATIONS, seed: int = 0,
    partitions: int | None = None,
) -> PipelineModel:
    """Perceptron 63-256-128-classes over normalised landmark arrays; the class
    letters travel with the model."""
    shaped = df.withColumn(vector, array_to_vector(vector))
    return _indexed_perceptron(shaped, label, vector, K.PERCEPTRON_HIDDEN, iterations, seed, partitions)


def pixel_classifier(
    df: DataFrame,
    label: str = "label",
    pixels: str = "pixels",
    hidden: Sequence[int] = (128,),
    iterations: int = 100,
    seed: int = 0,
    partitions: int | None = None,
) -> PipelineModel:
    """Image vector to class, on pixels scaled to 0..1."""
    shaped = pixel_vectors(df, pixels).withColumn(label, F.col(label).cast("string"))
    return _indexed_perceptron(shaped, label, "features", hidden, iterations, seed, partitions)


def apply_perceptron(model: PipelineModel, df: DataFrame, vector: str = "features") -> DataFrame:
    """Predicted letter for normalised landmark arrays."""
    return model.transform(df.withColumn(vector, array_to_vector(vector)))


def perceptron_record(
    model: PipelineModel, df: DataFrame, keep: Sequence[str], k: int = 3, vector: str = "features"
) -> DataFrame:
    """What a recogniser answers for a hand: letter, label and confidence of the best class
    and the ``k`` most probable classes."""
    classes = F.array(*[F.lit(c) for c in model.stages[-1].getLabels()])
    scores = vector_to_array("probability")
    best = argmax_prediction(scores, classes)
    scored = apply_perceptron(model, df, vector).select(
        *keep, best.alias("best"), topk_classes(scores, classes, k).alias("top")
    )
    return scored.select(*keep, "best.*", "top")


def pixel_vectors(df: DataFrame, pixels: str = "pixels") -> DataFrame:
    return df.withColumn("features", array_to_vector(pixel_scale(F.col(pixels))))

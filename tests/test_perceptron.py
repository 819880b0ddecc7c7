"""Perceptron training by blocks against differences and Spark ML's own fit."""

import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabulark.operators import models, perceptron

SIZES = [4, 7, 5, 3]


def rings(spark, n=600):
    """Three classes that no linear model separates."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (n, 4))
    y = np.digitize((x[:, :2] ** 2).sum(axis=1), [0.8, 2.2])
    rows = [(r.tolist(), float(c), "ABC"[c]) for r, c in zip(x, y)]
    df = spark.createDataFrame(rows, "a array<double>, number double, letter string")
    return df.withColumn("features", array_to_vector("a")).repartition(5).cache()


def mean_loss(model, df, label):
    p = vector_to_array("probability")
    return model.transform(df).agg(F.avg(-F.log(F.get(p, F.col(label).cast("int"))))).first()[0]


def test_slopes_match_differences():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 4)).astype(np.float32), rng.integers(0, 3, 50)
    w = perceptron.first_weights(SIZES, 0)

    def loss(v):
        return perceptron._add_slopes(v, SIZES, x, y, np.zeros(len(v)))

    slopes = np.zeros(len(w))
    perceptron._add_slopes(w, SIZES, x, y, slopes)
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-2
        assert abs((loss(w + step) - loss(w - step)) / 2e-2 - slopes[i]) < 2e-3


def test_fit_is_as_good_as_spark_ml(spark):
    df = rings(spark)
    weights = perceptron.fit_weights(df, "features", "number", SIZES, 150, 0)
    net = MultilayerPerceptronClassifier(labelCol="number", layers=SIZES, maxIter=150, seed=0)
    own = mean_loss(net.fit(df), df, "number")
    around = net.copy({net.maxIter: 0, net.initialWeights: Vectors.dense(weights)}).fit(df)
    assert mean_loss(around, df, "number") < max(1.3 * own, 0.1)


def test_model_holds_the_trained_weights(spark):
    """The model is Spark ML's, saved and applied like any other; its fit runs no Spark ML pass
    over the rows beyond one row, and its settings are the asked ones."""
    df = rings(spark)
    model = models._indexed_perceptron(df, "letter", "features", SIZES[1:3], 60, 0, 3)
    net = model.stages[0]
    assert net.getMaxIter() == 60 and not net.isDefined("initialWeights")
    assert list(net.getLayers()) == SIZES
    rows = df.select("a", "number").collect()
    x = np.array([r["a"] for r in rows], np.float32)
    y = np.array([int(r["number"]) for r in rows])
    mean = perceptron._add_slopes(
        net.weights.toArray(), SIZES, x, y, np.zeros(len(net.weights))
    ) / len(y)
    assert abs(mean - mean_loss(model, df, "number")) < 1e-4 and mean < 0.6
    want = perceptron.fit_weights(df, "features", "number", SIZES, 60, 0)
    assert len(want) == len(net.weights)

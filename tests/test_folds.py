"""Models fitted on all folds at once, against fits of single folds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tradewind.operators import boosting, folds as fo, learning as ln


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(7)
    x = draw.integers(0, 20, (1500, 4)) * np.array([1, 1000, 1, 1])
    y = x[:, 0] + x[:, 1] / 1000 + draw.normal(0, 6, 1500) > 21
    df = spark.createDataFrame([(r.tolist(), float(c), i % 3) for i, (r, c) in enumerate(zip(x.astype(float), y))], "x array<double>, label double, fold long")
    return df.select(array_to_vector("x").alias("features"), "label", "fold").persist()


def single(data, estimator, fold):
    scored = estimator.fit(data.where(F.col("fold") != fold)).transform(data.where(F.col("fold") == fold))
    return ln.accuracy(scored.select("label", F.col("prediction").alias("predicted"))).first().accuracy


@pytest.mark.parametrize("loss, plain", [("logistic", LogisticRegression), ("hinge", LinearSVC)])
def test_linear_folds_equal_single_fits(data, loss, plain):
    got = fo.FoldLinear(loss).accuracies(data, 3)
    assert got == pytest.approx([single(data, plain(), f) for f in range(3)], abs=0.02 if loss == "hinge" else 0.005)


def test_logistic_weights_are_those_of_mllib(data):
    model = fo.FoldLinear("logistic", tolerance=1e-10)
    blocks, width = model.blocks(data, 3)
    weights = model.fit(blocks, width, 3)
    spread = np.array([r.features.toArray() for r in data.collect()]).std(0)
    for fold in range(3):
        plain = LogisticRegression(tol=1e-10).fit(data.where(F.col("fold") != fold))
        assert weights[fold, :-1] / spread == pytest.approx(plain.coefficients.toArray(), rel=1e-3, abs=1e-5)


def test_boosted_folds_equal_single_fits(data):
    """Features have few values, so the cuts of all rows are those of each fold's rows."""
    got = fo.FoldBoosting(iterations=6, depth=3).accuracies(data, 3)
    assert got == [single(data, boosting.Boosting(6, depth=3), f) for f in range(3)]


def test_a_fold_without_rows_or_with_one_class(spark, data):
    for model in (fo.FoldLinear("logistic"), fo.FoldLinear("hinge"), fo.FoldBoosting(3, 2)):
        assert model.accuracies(data.withColumn("label", F.lit(1.0)), 4) == [1.0, 1.0, 1.0, None]


@pytest.mark.parametrize("name", ["LR", "SVC", "GBT"])
def test_folds_share_their_jobs(spark, data, name):
    rows = data.select(F.col("label").cast("int").alias("y"), F.xxhash64("features").cast("double").alias("a"), F.md5(F.xxhash64("features").cast("string")).alias("key"))
    jobs = {}
    for k in (2, 6):
        spark.sparkContext.setJobGroup(f"{name}-{k}", "folds")
        got = ln.model_comparison(rows, F.col("y"), ["a"], F.col("key"), {name: ln.default_models()[name]}, k).collect()
        jobs[k] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{name}-{k}"))
        assert [r.fold for r in got] == list(range(1, k + 1)) and all(0 <= r.accuracy <= 1 for r in got)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[6] < 2 * jobs[2]

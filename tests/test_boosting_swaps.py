"""Counts by pairs of features, places in trees, and cells swapped between rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.test_learning import training_rows
from tradewind.operators import boosting as bo
from tradewind.operators import learning as ln


def drawn(seed, width=5, rows=300, trees=7, depth=3):
    draw = np.random.default_rng(seed)
    x = draw.integers(0, bo.BINS, (width, rows)).astype(np.uint8)
    cuts = lambda: [int(v) for v in draw.choice([3, 12, 25, bo.BINS], 2**depth - 1)]
    made = [bo.Tree([int(j) for j in draw.integers(0, width, 2**depth - 1)], cuts(), [float(v) for v in draw.normal(size=2**depth)]) for _ in range(trees)]
    return draw, x, made


def leaf(tree, cells, depth):
    at = 0
    for level in range(depth):
        i = 2**level - 1 + at
        at = 2 * at + int(cells[tree.feature[i]] > tree.upto[i])
    return at


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_rows_go_down_all_trees(depth):
    _, x, trees = drawn(depth, depth=depth)
    assert trees[0].places(x, depth).tolist() == [leaf(trees[0], c, depth) for c in x.T]
    want = [sum(t.value[leaf(t, c, depth)] for t in trees) for c in x.T]
    assert bo._advanced(x, np.zeros(x.shape[1]), trees, depth) == pytest.approx(want)


@pytest.mark.parametrize("width,level,counted", [(5, 2, True), (4, 1, True), (5, 0, False), (1, 0, True)])
def test_counts_by_pairs_are_those_of_single_features(width, level, counted):
    draw, x, trees = drawn(1, width)
    y, f = draw.choice([-1, 1], x.shape[1]).astype(np.int8), draw.normal(size=x.shape[1])
    blocks = [pa.record_batch([pa.array([c.tobytes()], pa.binary()) for c in (x, y, f)], names=["x", "y", "f"])] * 2
    (got,) = bo._sums(blocks, trees[:2], 3, trees[2], level, False, width, counted)
    got = np.frombuffer(got.column("sums")[0].as_py()).reshape(-1, width, 2**level, bo.BINS)
    residual = 4 * y / (1 + np.exp(2 * y * bo._advanced(x, f, trees[:2], 3)))
    want = np.zeros((2, width, 2**level, bo.BINS))
    for i, p in enumerate(trees[2].places(x, level)):
        for j in range(width):
            want[:, j, p, x[j, i]] += 2, 2 * residual[i]
    assert got == pytest.approx(want if counted else want[1:])


def test_swapped_cells_are_scored_as_whole_rows_are(spark):
    """Rows of boosted trees travel as bins and are not repeated per feature; a model that is asked with vectors says the same."""
    rows = training_rows(spark, 300)
    features = ["customer_num", "kind", "size", "noise"]
    model = ln.win_model(rows, features, iterations=9)

    class Plain:
        def transform(self, frame):
            return model.model.transform(frame)

    given = (rows, F.when(F.col("i") % 7 > 0, F.col("iswon") == "True"), features, F.col("i").cast("string"))
    want = {r.feature: r.score for r in ln.permutation_importance(ln.Classifier(model.encoder, Plain()), *given, n=3, per_bucket=70).collect()}
    asked, whole = [], model.model.transform
    model.model.transform = lambda frame: asked.append(frame) or whole(frame)
    got = {r.feature: r.score for r in ln.permutation_importance(model, *given, n=3, per_bucket=70).collect()}
    assert got == pytest.approx(want) and set(got) == set(features) and not asked


def test_other_columns_are_fitted_without_a_join_of_codes(spark, monkeypatch):
    rows = training_rows(spark, 120).withColumn("customer_num", F.when(F.col("i") % 5 > 0, F.col("customer_num")))
    data = rows.select("customer_num", "kind", "size", (F.col("iswon") == "True").cast("double").alias("label"))
    fitted, fit = [], ln.Pipeline.fit
    monkeypatch.setattr(ln.Pipeline, "fit", lambda self, df: fitted.append(df) or fit(self, df))
    encoder = ln.encode_features(data, "label")
    assert "Join" not in fitted[0]._jdf.queryExecution().optimizedPlan().toString()
    known = data.where("customer_num IS NOT NULL")
    got = encoder.transform(data).select("size", vector_to_array("features").alias("x")).collect()
    mean, deviation = known.agg(F.avg("size"), F.stddev("size")).first()
    assert len(got) == known.count() and all(r.x[-1] == pytest.approx((r["size"] - mean) / deviation) for r in got)

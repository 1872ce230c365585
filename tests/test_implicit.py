"""Implicit factorisation over blocks of customers, against plain equations and MLlib."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tradewind.operators import implicit, recommending as rc

RATED = "cluster int, customer_num string, srp_2_desc string, rating double"


@pytest.mark.parametrize("rank", [3, 12])
def test_customers_solve_their_equations(rank):
    draw = np.random.default_rng(2)
    v, ratings = draw.normal(0, 1, (8, rank)), np.round(draw.uniform(-1, 1, (40, 8)), 1) * (draw.random((40, 8)) < 0.6)
    ratings[:, 0] = 0.5
    x = implicit.solved(v, ratings)
    for u, r in enumerate(ratings):
        matrix = v.T @ np.diag(1 + np.abs(r)) @ v + implicit.RIDGE * (r > 0).sum() * np.eye(rank)
        assert np.allclose(matrix @ x[u], v.T @ ((1 + np.abs(r)) * (r > 0)))


@pytest.mark.parametrize("cells", [250_000, 90])
def test_factors_fit_as_well_as_mllib(spark, monkeypatch, cells):
    """The objective of implicit ALS is no higher than with MLlib's factors, clusters being fitted by themselves."""
    monkeypatch.setattr(implicit, "CELLS", cells)
    draw = np.random.default_rng(6)
    tables = {c: np.where(draw.random((60, 9)) < 0.7, np.round(draw.normal(0, 1, (60, 3)) @ draw.normal(0, 1, (3, 9)), 2), 0) for c in (4, 7)}
    rows = [(c, f"u{u}", f"p{i}", float(t[u, i])) for c, t in tables.items() for u in range(60) for i in range(9) if t[u, i]]
    ratings = spark.createDataFrame(rows, RATED)
    fitted = rc.als_fill(ratings, rank=4, iters=15)
    every = ratings.select("cluster", "customer_num").distinct().crossJoin(ratings.select("srp_2_desc").distinct())
    got = {(r.cluster, int(r.customer_num[1:]), int(r.srp_2_desc[1:])): r.rating for r in fitted.score(every).collect()}
    for c, table in tables.items():
        coded = spark.createDataFrame([(int(u), int(i), float(table[u, i])) for u in range(60) for i in range(9) if table[u, i]], "u int, i int, r double")
        plain = ALS(rank=4, maxIter=15, implicitPrefs=True, seed=0, userCol="u", itemCol="i", ratingCol="r").fit(coded.join(coded.where("r > 0").select("u").distinct(), "u", "left_semi"))
        wanted = {(r.u, r.i): r.prediction for r in plain.transform(spark.range(60).select(F.col("id").cast("int").alias("u")).crossJoin(coded.select("i").distinct())).collect()}
        loss = lambda score: sum((1 + abs(table[u, i])) * ((table[u, i] > 0) - score(u, i)) ** 2 for u in range(60) for i in range(9) if (table[u] > 0).any())  # noqa: E731, B023
        assert loss(lambda u, i: got.get((c, u, i), 0.0)) < 1.05 * loss(lambda u, i: wanted[u, i])  # noqa: B023


def test_nobody_likes_anything(spark):
    ratings = spark.createDataFrame([(1, "a", "p", -1.0), (1, "b", "q", 0.0)], RATED)
    fitted = rc.als_fill(ratings, rank=2, iters=2)
    assert [r.rating for r in fitted.score(ratings).collect()] == [0.0, 0.0] and fitted.top(2).isEmpty()

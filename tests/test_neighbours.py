"""The nearest rows that SMOTE draws from, against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import learning as ln
from tradewind.operators import neighbours as nb


def brute_gaps(points: np.ndarray, k: int) -> np.ndarray:
    gaps = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(gaps, np.inf)
    return np.sort(gaps, axis=1)[:, :k]


@pytest.mark.parametrize(
    "n,block,kind", [(2500, 300, "uniform"), (2500, 20, "uniform"), (700, 50, "few values"), (900, 40, "equal"), (900, 40, "skewed"), (4, 5000, "uniform"), (60, 3, "uniform"), (1, 5, "uniform")]
)
def test_nearest_rows_are_those_of_all_pairs(spark, n, block, kind):
    draw = np.random.default_rng(4)
    points = draw.uniform(0, 1, (n, 6)) * [1, 1, 9, 1, 1, 1] if kind == "uniform" else draw.integers(0, 3, (n, 6)).astype(float)
    if kind == "equal":  # a third of the rows alike, and the others along one column
        points = np.zeros((n, 6))
        points[n // 3 :, 2] = draw.exponential(1, n - n // 3)
    if kind == "skewed":
        points = draw.lognormal(0, 2, (n, 6)) * [1000, 1, 1, 1, 0, 1]
    cols = list("abcdef")
    df = spark.createDataFrame([(str(i), *map(float, p)) for i, p in enumerate(points)], "key string, " + ", ".join(f"{c} double" for c in cols))
    got = {r.key: (np.array(r["at"]), np.array(r.others).reshape(-1, 6)) for r in nb.nearest_rows(df, cols, 5, block).collect()}
    want = brute_gaps(points, min(5, n - 1))
    assert len(got) == n
    for i in range(n):
        at, others = got[str(i)]
        assert (at == points[i]).all() and np.allclose(np.sort(((others - at) ** 2).sum(1)), want[i], rtol=1e-12, atol=0)


def test_rows_with_unknown_values(spark):
    points = [(str(i), float(i) if i % 4 else math.nan, 1.0) for i in range(40)]
    df = spark.createDataFrame(points, "key string, a double, b double")
    for block in (5, 100):
        got = {r.key: np.array(r.others).reshape(-1, 2) for r in nb.nearest_rows(df, ["a", "b"], 3, block).collect()}
        assert len(got) == 40 and all(len(v) == 3 for v in got.values())
        for key, a, _ in points:
            if not math.isnan(a):
                want = sorted(abs(a - x) for k, x, _ in points if k != key and not math.isnan(x))[:3]
                assert sorted(abs(got[key][:, 0] - a).tolist()) == want


def test_rows_meet_few_blocks(spark):
    """The share of rows and blocks that meet falls as rows grow; at 80 blocks in six columns it is below 0.2."""
    cols, shares = list("abcdef"), {}
    for n in (4000, 16_000):
        points = np.random.default_rng(2).uniform(0, 1, (n, 6))
        df = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points.tolist())], "key string, " + ", ".join(f"{c} double" for c in cols))
        _, blocks = nb.partition(df, cols, 200)
        shares[blocks.count()] = nb.first_pass(blocks, 5, 6).agg(F.sum(F.size("visits") + 1)).first()[0] / n / blocks.count()
    few, many = shares[min(shares)], shares[max(shares)]
    assert max(shares) >= 80 and many < 0.6 * few and many < 0.2, shares


def test_new_rows_lie_between_a_row_and_one_of_its_five_nearest(spark):
    draw = random.Random(5)
    cols = list("abcdef")
    rows = [(str(i), int(i < 1000), *(draw.uniform(0, 1) for _ in cols)) for i in range(2400)]
    df = spark.createDataFrame(rows, "k string, y int, " + ", ".join(f"{c} double" for c in cols))
    raised = ln.smote_upsample(df, "y", cols, F.col("k")).where("y = 1")
    given = np.array([r[2:] for r in rows[:1000]])
    known = {tuple(p) for p in given}
    new = [np.array(r[1:]) for r in raised.collect() if tuple(r[1:]) not in known]
    gaps = ((given[:, None] - given[None]) ** 2).sum(2)
    np.fill_diagonal(gaps, np.inf)
    near = np.argsort(gaps, axis=1)[:, :5]
    start, end = np.repeat(given, 5, axis=0), given[near.reshape(-1)]
    way = end - start
    length = (way**2).sum(1)

    def on_a_line(p):
        share = np.clip(((p - start) * way).sum(1) / length, 0, 1)
        return (((start + share[:, None] * way - p) ** 2).sum(1)).min() < 1e-18

    assert len(new) == 400 and all(on_a_line(p) for p in new)

"""Distances and clustering against brute force."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import clustering as cu
from tradewind.operators import distance as di
from tradewind.functions import scoring
from tradewind.operators import recommending as rc


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("d")).first().d


def test_value_distances(spark):
    num = scoring.numeric_distance(F.col("a"), F.col("b"))
    schema = "a double, b double"
    assert one(spark, num, schema, (1.0, 3.0)) == pytest.approx(2 / 3)
    for a, b in ((None, 1.0), (None, None), (math.inf, 1.0), (math.inf, math.inf), (math.nan, 1.0)):
        assert one(spark, num, schema, (a, b)) == 1.0
    same = scoring.matching_distance(F.col("a"), F.col("b"))
    assert [one(spark, same, "a string, b string", r) for r in (("a", "a"), ("a", "b"), (None, None))] == [0.0, 1.0, 1.0]


def test_jaccard_of_lists(spark):
    lists = {"ab": ["a", "b"], "bc": ["b", "c"], "aa": ["a", "a"], "a": ["a"], "none": None, "gone": None, "null": [None], "nulls": [None, None]}
    ids = spark.createDataFrame([(k,) for k in lists], "id string")
    long = spark.createDataFrame([(k, e) for k, v in lists.items() if v for e in v], "id string, element string").distinct()
    got = {(r.id_i, r.id_j): r.d for r in di.dist_jaccard(ids, "id", long).collect()}
    assert len(got) == 28
    for a, b in got:
        if lists[a] is None or lists[b] is None:
            want = 1.0
        else:
            x, y = set(lists[a]) - {None}, set(lists[b]) - {None}
            want = 1 - len(x & y) / len(x | y) if x | y else 0.0
        assert got[a, b] == pytest.approx(want), (a, b)
    assert got["ab", "bc"] == pytest.approx(2 / 3) and got["a", "aa"] == 0 and got["null", "nulls"] == 0


def entities(n, seed, clusters=3):
    draw = random.Random(seed)
    pick = lambda options: draw.choice(options)
    return [(f"e{i:03d}", pick(["x", "y", None]), pick(["s", "t", "u"]), draw.randint(1, clusters)) for i in range(n)]


W = {"f": 1.0, "g": 3.0}


def brute(a, b):
    d = lambda x, y: 0.0 if x is not None and x == y else 1.0
    return (d(a[1], b[1]) + 3 * d(a[2], b[2])) / 4


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, f string, g string, cluster int")


def pair_frame(spark, ids, dist):
    rows = [(a, b, float(dist(a, b))) for a, b in itertools.combinations(sorted(ids), 2)]
    return spark.createDataFrame(rows, "id_i string, id_j string, d double")


def test_profiles_equal_all_pairs(spark):
    rows = entities(60, 2)
    at = {r[0]: r for r in rows}
    pairs = pair_frame(spark, at, lambda a, b: brute(at[a], at[b]))
    df = frame(spark, rows)
    labels = df.select("id", "cluster")
    exact = {r.id: r.score for r in cu.silhouette(pairs, labels).collect()}
    grouped = {r.id: r.score for r in cu.silhouette_by_profile(df, "id", W).collect()}
    assert grouped == pytest.approx(exact)
    by_profile, by_pair = cu.wcss_by_profile(df, W).first(), cu.wcss(pairs, labels).first()
    assert (by_profile.wcss, by_profile.n_clusters) == (pytest.approx(by_pair.wcss), by_pair.n_clusters)
    known, unknown = df.where("cluster = 1"), df.where("cluster > 1")
    near = {r.id: (r.nearest, r.d) for r in di.nearest_by_profile(unknown, known, "id", W).collect()}
    want = {r[0]: min((brute(r, k), k[0]) for k in rows if k[3] == 1) for r in rows if r[3] > 1}
    assert near == {k: (v[1], v[0]) for k, v in want.items()}


@pytest.mark.parametrize("weighting", ["inverse", "distance"])
def test_unseen_customers_equal_the_weighted_mean(spark, weighting):
    rows = entities(40, 4)
    draw = random.Random(9)
    rated = [r for r in rows if draw.random() < 0.6]
    ratings = [(r[3], r[0], p, draw.uniform(-1, 1)) for r in rated for p in ("P", "Q")]
    value = {(r[1], r[2]): r[3] for r in ratings}
    df = frame(spark, rows).withColumnRenamed("id", "customer_num")
    rat = spark.createDataFrame(ratings, "cluster int, customer_num string, srp_2_desc string, rating double")
    got = {(r[1], r[2]): r.rating for r in rc.fill_unseen_customers(rat, df, W, weighting).collect()}
    weigh = (lambda d: 1 / max(d, 1e-6)) if weighting == "inverse" else (lambda d: max(d, 1e-6))
    want = {}
    for r in rows:
        peers = [k for k in rated if k[3] == r[3]]
        if r not in rated and peers:
            for p in ("P", "Q"):
                w = [weigh(brute(r, k)) for k in peers]
                want[r[0], p] = sum(x * value[k[0], p] for x, k in zip(w, peers)) / sum(w)
    assert got == pytest.approx(want)


def sequential_ward(d, t):
    """Merge the closest two clusters until none is within t, updating by the Lance-Williams rule."""
    d = d.astype(float) ** 2
    np.fill_diagonal(d, np.inf)
    sizes, groups = {i: 1 for i in range(len(d))}, {i: {i} for i in range(len(d))}
    while len(groups) > 1:
        live = sorted(groups)
        i, j = min(itertools.combinations(live, 2), key=lambda ij: d[ij])
        if d[i, j] > t * t:
            break
        for k in live:
            if k not in (i, j):
                ni, nj, nk = sizes[i], sizes[j], sizes[k]
                d[i, k] = d[k, i] = ((ni + nk) * d[i, k] + (nj + nk) * d[j, k] - nk * d[i, j]) / (ni + nj + nk)
        sizes[i] += sizes[j]
        groups[i] |= groups.pop(j)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed,t", [(1, 0.9), (2, 1.4)])
def test_ward_equals_sequential_merging(spark, seed, t):
    rng = np.random.default_rng(seed)
    n = 30
    m = rng.uniform(0.05, 1, (n, n))
    m = (m + m.T) / 2
    ids = [f"e{i:03d}" for i in range(n)]
    labels = cu.ward_cutoff(pair_frame(spark, ids, lambda a, b: m[int(a[1:]), int(b[1:])]), t).collect()
    groups = {}
    for r in labels:
        groups.setdefault(r.cluster, set()).add(int(r.id[1:]))
    assert {frozenset(g) for g in groups.values()} == sequential_ward(m, t)


def ward_rows(n_profiles, seed, missing=False):
    """Profiles of three features, each held by another number of customers, so that no two heights are equal."""
    draw = random.Random(seed)
    chosen = draw.sample(list(itertools.product("ab", "cde", "fghi")), n_profiles)
    held = draw.sample(range(1, 24), n_profiles)
    rows = [p for p, n in zip(chosen, held) for _ in range(n)]
    if missing:
        rows += [(None, "c", "f"), ("a", None, None)]
    return [(f"c{i:03d}", *p) for i, p in enumerate(rows)]


@pytest.mark.parametrize("t,missing", [(0.5, True), (2.9, False), (2.9, True), (50.0, False)])
def test_ward_of_customers_equals_sequential_merging(spark, t, missing):
    w = {"f": 1.0, "g": 1.37, "h": 2.91}
    rows = ward_rows(14, 5, missing)
    differ = lambda x, y: 0.0 if x is not None and x == y else 1.0
    d = np.array([[sum(v * differ(a[i], b[i]) for i, v in enumerate(w.values(), 1)) / sum(w.values()) for b in rows] for a in rows])
    df = spark.createDataFrame([*rows, (None, "a", "c", "f")], "id string, f string, g string, h string")
    groups = {}
    for r in cu.ward_by_profile(df, "id", w, t).collect():
        groups.setdefault(r.cluster, set()).add(int(r.id[1:]))
    assert {frozenset(g) for g in groups.values()} == sequential_ward(d, t)


def test_ward_of_customers_at_the_edges(spark):
    w = {"f": 1.0}
    none = spark.createDataFrame([], "id string, f string, cluster string")
    assert cu.ward_by_profile(none, "id", w, 1.0).count() == 0
    same = spark.createDataFrame([("a", "x", "z"), ("b", "x", "z"), ("b", "x", "z")], "id string, f string, cluster string")
    assert [tuple(r) for r in cu.ward_by_profile(same, "id", w, 1.0).orderBy("id").collect()] == [("a", 1), ("b", 1), ("b", 1)]
    clash = spark.createDataFrame([("a", "x"), ("b", "y")], "profile string, n string")
    assert [tuple(r) for r in cu.ward_by_profile(clash, "profile", {"n": 1.0}, 0.5).orderBy("id").collect()] == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="distinct profiles"):
        cu.ward_by_profile(spark.range(5).selectExpr("string(id) AS id", "string(id) AS f"), "id", w, 1.0, most=4)


def test_wcss_and_silhouette_by_hand(spark):
    pairs = pair_frame(spark, ["a", "b", "c"], lambda a, b: 1.0)
    together = spark.createDataFrame([(i, 1) for i in "abc"], "id string, cluster int")
    assert cu.wcss(pairs, together).first().wcss == pytest.approx(1.0)
    split = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id string, cluster int")
    assert {r.id: r.score for r in cu.silhouette(pairs, split).collect()} == {"a": 0.0, "b": 0.0, "c": 0.0}


def test_weights_of_a_target_sum_to_one(spark):
    rng = np.random.default_rng(3)
    pairs = pair_frame(spark, "abcdef", lambda a, b: rng.choice([0.0, 0.2, 0.9]))
    ids = lambda s: spark.createDataFrame([(c,) for c in s], "k string")
    for weighting in ("inverse", "distance"):
        w = di.affinity_weights(pairs, ids("ab"), ids("cdef"), "k", weighting)
        assert [r.s for r in w.groupBy("target").agg(F.sum("w").alias("s")).collect()] == pytest.approx([1.0, 1.0])


def test_selection_and_search(spark):
    rng = np.random.default_rng(5)
    rows = [(a, b, *map(float, rng.uniform(0, 1, 2))) for a, b in itertools.combinations("abcdef", 2)]
    pairs = spark.createDataFrame(rows, "id_i string, id_j string, f double, g double")
    steps = cu.forward_feature_selection(pairs, ["f", "g"], 0.6).collect()
    assert [s.step for s in steps] == [1, 2] and {s.feature for s in steps} == {"f", "g"}
    assert [tuple(s) for s in cu.forward_feature_selection(pairs, ["f", "g"], 0.6, top_feature=1).collect()] == [tuple(steps[0])]
    runs = cu.weight_search(pairs, ["f", "g"], 0.6, n_trials=3, seed=1)
    best = {r.feature: r.weight for r in cu.best_run_weights(runs, ["f", "g", "h"]).collect()}
    assert best["h"] == pytest.approx((best["f"] + best["g"]) / 2)


def best_of_search(value, proposals, n_trials, seed):
    draw, done = random.Random(seed), []
    while len(done) < n_trials:
        w = proposals(done, ["f", "g", "h"], draw) if len(done) >= 5 else cu.random_weights(["f", "g", "h"], draw)
        done.append((w, value(w)))
    assert all(1 <= x <= 10 for w, _ in done for x in w.values())
    return min(v for _, v in done)


def test_proposals_beat_chance():
    """The same first five trials, then 25 by density ratio or by chance, on a bowl, over 20 seeds."""
    bowl = lambda w: (w["f"] - 9) ** 2 + (w["g"] - 2) ** 2 + (w["h"] - 5) ** 2
    adaptive = [best_of_search(bowl, cu.propose_weights, 30, seed) for seed in range(20)]
    chance = [best_of_search(bowl, lambda done, features, draw: cu.random_weights(features, draw), 30, seed) for seed in range(20)]
    assert sum(adaptive) < 0.6 * sum(chance)


@pytest.mark.parametrize("n_trials", [12, 30])
def test_search_beats_chance_on_average(n_trials):
    """Sums of squares of Ward clusters, over 20 seeds: the mean is lower, a single seed may be worse."""
    m = np.random.default_rng(8).uniform(0, 1, (3, 8, 8))
    m = (m + m.transpose(0, 2, 1)) / 2

    def value(w):
        d = np.tensordot([w[f] for f in "fgh"], m, 1) / sum(w.values())
        return sum(sum(d[a, b] ** 2 for a, b in itertools.combinations(g, 2)) / len(g) for g in sequential_ward(d, 0.6))

    adaptive = [best_of_search(value, cu.propose_weights, n_trials, seed) for seed in range(20)]
    chance = [best_of_search(value, lambda done, features, draw: cu.random_weights(features, draw), n_trials, seed) for seed in range(20)]
    assert sum(adaptive) < sum(chance)


def test_search_tries_new_weights(spark):
    rng = np.random.default_rng(8)
    rows = [(a, b, *map(float, rng.uniform(0, 1, 3))) for a, b in itertools.combinations("abcdefgh", 2)]
    pairs = spark.createDataFrame(rows, "id_i string, id_j string, f double, g double, h double")
    runs = cu.weight_search(pairs, ["f", "g", "h"], 0.6, n_trials=7, seed=1).collect()
    assert len({tuple(sorted(r.weights.items())) for r in runs}) == len(runs) == 7


def test_many_distinct_profiles(spark):
    """30,000 customers that all differ: no pair of them is ever made."""
    n = 30_000
    df = spark.range(n).select(
        F.format_string("e%05d", "id").alias("id"), F.col("id").cast("string").alias("f"), F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("g"), (F.col("id") % 2).cast("int").alias("cluster")
    )
    scores = cu.silhouette_by_profile(df, "id", W)
    # In a cluster of 15,000, two in three differ in g (weight 3 of 4) and all in f.
    first = scores.where("id = 'e00000'").first()
    own = (1 * 14_999 + 3 * 10_000) / 4 / 14_999
    other = 1 - 3 * 5000 / 4 / 15_000
    assert first.score == pytest.approx((other - own) / max(other, own)) and scores.count() == n
    assert cu.wcss_by_profile(df, W).first().n_clusters == 2
    near = di.nearest_by_profile(df.where("cluster = 1"), df.where("cluster = 0"), "id", W)
    assert near.where("id = 'e00001'").first()[1:] == ("e00004", 0.25) and near.count() == n // 2


def test_a_list_element_of_many_holders(spark):
    held = spark.range(400).select(F.format_string("p%03d", "id").alias("id"), F.lit("hot").alias("element"))
    pairs = di.shared_counts(held.union(held.limit(2).withColumn("element", F.lit("rare"))), "id")
    assert pairs.count() == 400 * 399 // 2 and pairs.where("shared = 2").count() == 1


def test_vector_and_affinity_clusters(spark):
    rows = [(f"e{i:02d}", "x" if i < 20 else "y", float(i < 20) + i / 100, ["a"] if i < 20 else ["b", "c"]) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, f string, n double, items array<string>")
    by = {r.id: r.cluster for r in cu.cluster_vectors(df, "id", ["f"], ["n"], ["items"], 2).collect()}
    assert {frozenset(k for k in by if by[k] == c) for c in set(by.values())} == {frozenset(r[0] for r in rows[:20]), frozenset(r[0] for r in rows[20:])}
    far = {r[0]: r[1] for r in rows}
    pairs = pair_frame(spark, far, lambda a, b: 0.1 if far[a] == far[b] else 0.95)
    linked = {r.id: r.cluster for r in cu.cluster_affinity(pairs, 2).collect()}
    assert len(linked) == 40 and len({linked[r[0]] for r in rows[:20]}) == len({linked[r[0]] for r in rows[20:]}) == 1

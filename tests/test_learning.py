"""Sampling, evaluation, pair scoring and recommendations."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import learning as ln
from tradewind.operators import logistic as lg
from tradewind.operators import recommending as rc
from tradewind.operators import windows as wn

PAIRS = "customer_num string, srp_2_desc string"


def mode(values):
    counts = Counter(values)
    return min(counts, key=lambda v: (-counts[v], v)) if counts else None


@pytest.mark.parametrize("values", [[0.0, 1.0], [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]])
def test_impute_predict_equals_listing_the_rows(spark, values):
    draw = random.Random(len(values))
    rows = [(f"c{draw.randint(1, 6)}", f"p{draw.randint(1, 5)}", draw.choice(values)) for _ in range(80)]
    rows += [("c1", "p1", draw.choice(values)) for _ in range(40)]
    requests = [(f"c{i}", f"p{j}") for i in range(1, 10) for j in range(1, 9)]
    near_c, near_p = {"c7": "c2", "c8": "c1"}, {"p6": "p1", "p7": "p3"}
    want = {}
    for c, p in requests:
        c2 = c if any(r[0] == c for r in rows) else near_c.get(c)
        p2 = p if any(r[1] == p for r in rows) else near_p.get(p)
        own = mode([r[2] for r in rows if r[:2] == (c, p)])
        if own is not None:
            want[c, p] = (own, 0)
        elif c2 and p2:
            want[c, p] = (mode([r[2] for r in rows if r[0] == c2 or r[1] == p2]), 1)
        else:
            want[c, p] = ((0 if c2 else -1) + (0 if p2 else -2), -1)
    links = lambda d: spark.createDataFrame(list(d.items()), "id string, nearest string")
    got = ln.impute_predict(
        spark.createDataFrame(requests, PAIRS), spark.createDataFrame(rows, PAIRS + ", predicted double"), links(near_c), links(near_p)
    )
    assert {(r[0], r[1]): (r.outcome, r.imputed) for r in got.collect()} == want


def test_undersample_takes_the_smallest_hashes(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    taken = ln.undersample(df, "y", F.col("k"))
    assert {r.y: r["count"] for r in taken.groupBy("y").count().collect()} == {0: 300, 1: 300}
    hashed = df.where("y = 0").orderBy(F.md5("k")).limit(300)
    assert {r.k for r in taken.where("y = 0").collect()} == {r.k for r in hashed.collect()}


@pytest.mark.parametrize("few", [40, 290])
def test_smote_balances_inside_the_minority(spark, few):
    draw = random.Random(7)
    rows = [(str(i), int(i < few), draw.uniform(0, 1) + 5 * (i < few), draw.uniform(0, 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, y int, a double, b double")
    raised = ln.smote_upsample(df, "y", ["a", "b"], F.col("k"), per_range=20)
    assert {r.y: r["count"] for r in raised.groupBy("y").count().collect()} == {0: 600 - few, 1: 600 - few}
    low = raised.where("y = 1").agg(F.min("a").alias("lo"), F.max("a").alias("hi")).first()
    assert 5 <= low.lo and low.hi <= 6


def test_report_counts_empty_classes_as_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, predicted int")
    rows = {r.label: r for r in ln.classification_report(df).collect()}
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1, rows["1"].support) == (0, 0, 0, 1)
    assert rows["0"].precision == pytest.approx(2 / 3) and rows["accuracy"].f1 == pytest.approx(2 / 3)
    assert ln.confusion_matrix(df).where("n = 0").count() == 2


def training_rows(spark, n=600):
    draw, rows = random.Random(3), []
    for i in range(n):
        kind, size = draw.choice("abcd"), draw.uniform(0, 10)
        rows.append((f"c{i % 40}", f"p{i % 7}", kind, size, draw.uniform(0, 1), "True" if size > 5 or kind == "a" else "False", i))
    return spark.createDataFrame(rows, PAIRS + ", kind string, size double, noise double, iswon string, i int")


def test_models_learn_and_leave_unseen_categories_out(spark):
    rows = training_rows(spark)
    model = ln.win_model(rows, ["customer_num", "kind", "size", "noise"], iterations=5)
    scored = ln.batch_predict(model, rows, probability=True)
    assert scored.count() == 600 and scored.where("win_prob < 0 OR win_prob > 1").count() == 0
    right = ln.accuracy(scored.withColumn("label", (F.col("iswon") == "True").cast("int"))).first().accuracy
    assert right > 0.9
    strange = rows.limit(4).withColumn("kind", F.when(F.col("i") % 2 == 0, "zzz").otherwise(F.col("kind")))
    assert ln.batch_predict(model, strange).count() == 2
    assert ln.batch_predict(model, rows.limit(4).withColumn("customer_num", F.lit("new"))).count() == 0
    imp = {
        r.feature: r.score
        for r in ln.permutation_importance(
            model, rows, F.col("iswon") == "True", ["size", "noise"], F.col("i").cast("string"), n=2, per_bucket=80
        ).collect()
    }
    assert imp["size"] > 0.1 > abs(imp["noise"])
    rated = rc.rate_pairs(model, rows)
    assert rated.where("rating < -1 OR rating > 1").count() == 0 and rated.count() == 600


def taste(seed):
    draw, rows = random.Random(seed), []
    for i in range(60):
        for j in range(8):
            if draw.random() < 0.7:
                rows.append((i % 2, f"c{i:02d}", f"p{j}", 1.0 if (i // 2 + j) % 2 else -0.5))
    return rows + [(0, "sad", f"p{j}", -1.0) for j in range(8)]


def test_permutation_importance_scores_all_features_in_one_pass(spark):
    """The model is asked twice however many features there are; equal to permuting the given columns one by one."""
    rows = training_rows(spark, 300)
    features = ["customer_num", "kind", "size", "noise"]
    model = ln.win_model(rows, features, iterations=3)
    assert sorted(model.encoder.places().items(), key=lambda x: x[1]) == [("kind", 0), ("customer_num", 1), ("size", 2), ("noise", 3)]

    class Counted:
        calls = 0

        def transform(self, frame):
            Counted.calls += 1
            return model.model.transform(frame)

    counted = ln.Classifier(model.encoder, Counted())
    got = ln.permutation_importance(counted, rows, F.col("iswon") == "True", features, F.col("i").cast("string"), n=2, per_bucket=1000)
    got = {r.feature: r.score for r in got.collect()}
    assert Counted.calls == 2 and set(got) == set(features)
    base = ln.accuracy(ln.batch_predict(model, rows).withColumn("label", (F.col("iswon") == "True").cast("int"))).first().accuracy
    given = rows.toPandas()
    for feature in features:
        moved = []
        for rep in (1, 2):
            order = [r.i for r in rows.select("i", F.md5(F.concat_ws("|", F.col("i").cast("string"), F.lit(str(rep)))).alias("d")).orderBy("d").collect()]
            other = given.set_index("i").loc[order[1:] + order[:1], feature].tolist()
            part = given.set_index("i").loc[order].reset_index()
            part[feature] = other
            moved.append(ln.batch_predict(model, spark.createDataFrame(part)).withColumn("label", (F.col("iswon") == "True").cast("int")))
        assert got[feature] == pytest.approx(base - ln.accuracy(moved[0].unionByName(moved[1])).first().accuracy)


RATED = "cluster int, customer_num string, srp_2_desc string, rating double"


def test_ratings_that_cancel_out_are_exactly_zero(spark):
    """Sums of doubles give 1e-17 or so for these, above or below zero by the order of the rows."""
    given = [0.8, -0.4, 0.3999999999999999, -0.8, -0.3999999999999999, 0.4]
    rows = [("a", "p", r) for r in (0.8, -0.4, -0.3999999999999999)] + [("b", "p", r) for r in (-0.8, 0.3999999999999999, 0.3999999999999999)]
    rows += [("c", "p", r) for r in given]
    labels = spark.createDataFrame([(c, 1) for c in "abc"], "customer_num string, cluster int")
    got = rc.cluster_ratings(spark.createDataFrame(rows, PAIRS + ", rating double"), labels).collect()
    assert sorted((r.customer_num, r.rating) for r in got) == [("a", 0.0), ("b", 0.0), ("c", 0.0)]


def test_als_keeps_factors_and_scores_what_is_asked(spark):
    ratings = spark.createDataFrame(taste(2), RATED)
    fitted = rc.als_fill(ratings, rank=6, iters=5)
    scored = fitted.score(ratings)
    assert scored.count() == ratings.count() and scored.where("customer_num = 'sad' AND rating <> 0").count() == 0
    liked = scored.join(ratings.withColumnRenamed("rating", "true"), ["cluster", "customer_num", "srp_2_desc"])
    means = {r.good: r.m for r in liked.groupBy((F.col("true") > 0).alias("good")).agg(F.avg("rating").alias("m")).collect()}
    assert means[True] > means[False] + 0.5
    top = fitted.top(3)
    assert top.count() == 60 * 3 and top.groupBy("customer_num").count().where("count <> 3").isEmpty()


def test_logistic_factors_tell_liked_from_not(spark):
    ratings = spark.createDataFrame(taste(4), RATED)
    scored = rc.logistic_mf(ratings, factors=4)
    assert scored.count() == ratings.count()
    both = scored.withColumnRenamed("rating", "score").join(ratings, ["cluster", "customer_num", "srp_2_desc"])
    means = {r.liked: r.m for r in both.groupBy((F.col("rating") > 0).alias("liked")).agg(F.avg("score").alias("m")).collect()}
    assert means[True] > means[False]


@pytest.mark.parametrize("cells,most", [(1_000_000, 200_000), (150, 1)])
def test_logistic_factors_predict_held_out_pairs(spark, monkeypatch, cells, most):
    """Log-loss of pairs left out of the fit is below that of the constant, however customers and clusters are dealt."""
    monkeypatch.setattr(lg, "CELLS", cells)
    monkeypatch.setattr(lg, "MOST", most)
    draw = np.random.default_rng(6)
    rows = []
    for cluster in (1, 2):
        people, goods = draw.normal(0, 1, (120, 3)), draw.normal(0, 1, (25, 3))
        liked = draw.uniform(0, 1, (120, 25)) < 1 / (1 + np.exp(-2 * people @ goods.T))
        rows += [(cluster, f"c{cluster}-{u}", f"p{i}", 1.0 if liked[u, i] else -1.0) for u in range(120) for i in range(25)]
    ratings = spark.createDataFrame(rows, RATED)
    held = F.pmod(F.xxhash64("customer_num", "srp_2_desc"), F.lit(5)) == 0
    test = ratings.where(held)
    found = lg.logistic_factors(ratings.where(~held), factors=3).rate(test).withColumnRenamed("rating", "odds").join(test, ["cluster", "customer_num", "srp_2_desc"]).collect()
    share = np.mean([r.rating > 0 for r in found])
    loss = np.mean([np.log1p(np.exp(-r.odds if r.rating > 0 else r.odds)) for r in found])
    constant = -(share * np.log(share) + (1 - share) * np.log(1 - share))
    assert len(found) == test.count() and loss < 0.85 * constant, (loss, constant)


def test_logistic_factors_of_strangers(spark):
    ratings = spark.createDataFrame([(1, "a", "p", 1.0), (1, "a", "p", -1.0), (1, None, "p", 1.0), (1, "b", "q", -1.0)], RATED)
    fitted = lg.logistic_factors(ratings, factors=2, iters=2)
    asked = spark.createDataFrame([(1, "z", "p", 0.0), (2, "a", "p", 0.0)], RATED)
    assert [r.rating for r in fitted.rate(asked).collect()] == [0.0, 0.0] and fitted.customers.count() == 2
    with pytest.raises(ValueError):
        lg.logistic_factors(ratings.limit(0))


def test_factor_counts(spark):
    sweep = spark.createDataFrame([(2, 0.9), (4, 0.5), (8, 0.4)], "factors int, rmse double")
    assert {r.factors: r.delta for r in wn.rmse_delta(sweep).collect()} == {2: None, 4: pytest.approx(0.4), 8: pytest.approx(0.1)}
    assert wn.best_factors(sweep).first().factors == 4


def test_models_are_saved_and_loaded(spark, tmp_path):
    rows = training_rows(spark)
    model = ln.win_model(rows, ["customer_num", "kind", "size"], iterations=3)
    model.save(f"{tmp_path}/model")
    loaded = ln.Classifier.load(spark, f"{tmp_path}/model")
    score = lambda m: {r.i: r.win_prob for r in ln.batch_predict(m, rows, probability=True).collect()}
    assert score(loaded) == score(model)


@pytest.mark.parametrize("sampling", ["default", "downsample", "upsample"])
def test_sampling_of_training_rows(spark, sampling):
    rows = training_rows(spark).withColumn(ln.LABEL, (F.col("iswon") == "True").cast("double"))
    sizes = {r[0]: r["count"] for r in ln.sampled(rows, sampling, F.col("i").cast("string")).groupBy(ln.LABEL).count().collect()}
    given = {r[0]: r["count"] for r in rows.groupBy(ln.LABEL).count().collect()}
    want = {"default": given, "downsample": dict.fromkeys(given, min(given.values())), "upsample": dict.fromkeys(given, max(given.values()))}
    assert sizes == want[sampling]


def test_propensity_and_model_comparison(spark):
    rows = training_rows(spark).withColumn("outcome", (F.col("iswon") == "True").cast("int"))
    model = ln.propensity_model(rows, ["kind", "size", "noise"], trees=10, depth=5, sampling="downsample")
    scored = ln.batch_predict(model, rows).withColumn("label", F.col("outcome"))
    assert ln.accuracy(scored).first().accuracy > 0.9
    few = {k: v for k, v in ln.default_models().items() if k in ("DT", "LR")}
    folds = ln.model_comparison(rows, F.col("outcome"), ["kind", "size", "noise"], F.col("i").cast("string"), models=few, k=3).collect()
    assert len(folds) == 6 and min(r.accuracy for r in folds) > 0.6


def test_recommend_without_remark_and_for_one_customer(spark):
    matrix = spark.createDataFrame([("a", "old", 0.2), ("a", "new", 0.6), ("a", "other", 0.9), ("b", "new", 0.1)], PAIRS + ", rating double")
    curated = spark.createDataFrame([("old", "new"), ("new", "new")], "srp_2_desc string, updated string")
    owned = spark.createDataFrame([("a", "new")], PAIRS)
    got = rc.recommend_with_remark(matrix, None, owned, curated, {}, customers=["a"], remark=False)
    assert [(r.Customer, r.Product, r.Rating) for r in got.collect()] == [("a", "new", 0.4)]
    assert got.columns == ["Customer", "Product", "Rating", "pos"]
    every = rc.recommend(matrix, None, owned, curated, {}, remark=False, curated_only=False, replacement=False)
    assert every.count() == 4

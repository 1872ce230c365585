"""Registered queries: classifiers, pair scoring, collaborative filtering and recommendations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import cleaning as cl
from ..operators import clustering as cu
from ..operators import distance as di
from ..operators import joins as jn
from ..operators import learning as ln
from ..operators import ranking as rk
from ..operators import recommending as rc
from ..operators import windows as wn
from ..settings import CUSTOMER, PAIR, PRODUCT
from ..sources import tables as t
from ..sources.stages import materialize
from . import datasets as ds
from . import frames as fr
from .building import CUSTOMER_WEIGHTS, clustered_by_features, clustered_customers, product_distances
from .relational import six

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _win_train(spark, root) -> DataFrame:
    return materialize(ds.prediction_train(t.sales(spark, root, True), t.opportunities(spark, root)))


def _propensity_rows(spark, root) -> DataFrame:
    return materialize(ds.propensity_train(t.sales(spark, root, True)))


# A name stands for its customer, and a ship date for no kind of row.
WIN_FEATURES = [c for c in ds.FEATURES if c not in ("iswon", "customer_name", "dtl_actual_ship_dt")]
PROPENSITY_FEATURES = [*PAIR, *ds.PROPENSITY_COLS, "gap_mean", "gap_std", "last_purchase_to_cutoff"]


def _row_key():
    return F.concat_ws("|", *PAIR)


def _opp_key():
    return F.concat_ws("|", CUSTOMER, PRODUCT, "opp_id")


def _win(rows: DataFrame) -> ln.Classifier:
    return ln.win_model(rows, WIN_FEATURES)


def _halves(spark, root):
    rows = ln.train_test_split(_propensity_rows(spark, root), _row_key())
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@query
def encode_features(spark, root):
    cols = ["srp_1_desc", "dtl_value_package", CUSTOMER]
    rows = fr.sales_before(spark, root).select(*PAIR, "srp_1_desc", "dtl_value_package", "dtl_invoice_num")
    return ln.ordinal_codes(rows, cols).select(*PAIR, "dtl_invoice_num", *[f"{c}_code" for c in cols])


@query
def train_test_split(spark, root):
    return ln.train_test_split(t.opportunities(spark, root), _opp_key()).select(*PAIR, "opp_id", "split")


@query
def undersample(spark, root):
    return ln.undersample(t.opportunities(spark, root).select(*PAIR, "opp_id", "iswon"), "iswon", _opp_key())


@query
def smote_upsample(spark, root):
    """Rows of each class after raising, how many are new, and whether every new value lies within its class."""
    cols = ["dtl_qty_ordered", "dtl_unit_cost", "dtl_unit_price", "gap_mean", "gap_std", "last_purchase_to_cutoff"]
    rows = _propensity_rows(spark, root)
    raised = materialize(ln.smote_upsample(rows, "outcome", cols, _row_key()))
    given = rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_given"), *[F.min(c).alias(f"low_{c}") for c in cols], *[F.max(c).alias(f"high_{c}") for c in cols])
    inside = F.lit(True)
    for c in cols:
        inside = inside & F.col(c).between(F.col(f"low_{c}") - 1e-6, F.col(f"high_{c}") + 1e-6)
    both = raised.join(given, "outcome").groupBy(F.col("outcome").cast("bigint").alias("outcome"), "n_given")
    return both.agg(F.count(F.lit(1)).alias("n"), F.min(inside).alias("inside")).select("outcome", "n", (F.col("n") - F.col("n_given")).alias("n_new"), "inside")


@query
def win_model(spark, root):
    """Accuracy on the training rows and on the rows after the cutoff."""
    train = _win_train(spark, root)
    model = _win(train)
    parts = {"train": train, "test": ds.prediction_test(t.sales(spark, root, True), t.opportunities(spark, root))}
    results = []
    for name, rows in parts.items():
        predicted = ln.batch_predict(model, rows).withColumn("label", (F.col("iswon") == "True").cast("bigint"))
        results.append(ln.accuracy(predicted).select(F.lit(name).alias("part"), F.round("accuracy", 4).alias("accuracy")))
    return results[0].unionByName(results[1])


@query
def propensity_model(spark, root):
    halves = _halves(spark, root)
    model = ln.propensity_model(halves[0], PROPENSITY_FEATURES)
    results = []
    for name, rows in zip(("train", "test"), halves):
        predicted = ln.batch_predict(model, rows).withColumn("label", F.col("outcome").cast("bigint"))
        results.append(ln.accuracy(predicted).select(F.lit(name).alias("part"), F.round("accuracy", 4).alias("accuracy")))
    return results[0].unionByName(results[1])


@query
def batch_predict(spark, root):
    """Training rows by outcome, and whether all their win probabilities are probabilities."""
    train = _win_train(spark, root)
    scored = ln.batch_predict(_win(train), train, probability=True)
    return scored.groupBy("iswon").agg(F.count(F.lit(1)).alias("n"), ((F.min("win_prob") >= 0) & (F.max("win_prob") <= 1)).alias("in_range"))


@query
def accuracy(spark, root):
    return ln.accuracy(fr.labelled(spark, root)).withColumns(six("accuracy"))


@query
def classification_report(spark, root):
    return ln.classification_report(fr.labelled(spark, root)).withColumns(six("precision", "recall", "f1"))


@query
def confusion_matrix(spark, root):
    return ln.confusion_matrix(fr.labelled(spark, root))


def _active(spark, root):
    return fr.curated(spark, root).where("active = 'Y'")


def _scored_halves(spark, root):
    """Scored sales rows up to the cutoff, which are trained on, and after it: the sales are joined once and written."""
    return cl.cutoff_split(materialize(fr.scored(t.sales(spark, root))), "dtl_invoice_dt")


def _valued(scored, value):
    """Training rows with the value to be imputed."""
    return scored.select(*PAIR, value.alias("predicted"))


def _near_ids(spark, root, scored):
    """The nearest trained customer and product of each one without training rows."""
    trained = materialize(scored.select(*PAIR).distinct())
    base, products = t.baseline(spark, root), fr.curated(spark, root)
    customers, bought = trained.select(CUSTOMER).distinct(), trained.select(PRODUCT).distinct()
    near_c = di.nearest_by_profile(base.join(customers, CUSTOMER, "left_anti"), base.join(customers, CUSTOMER, "left_semi"), CUSTOMER, CUSTOMER_WEIGHTS)
    near_p = di.nearest_entity(product_distances(spark, root), products.join(bought, PRODUCT, "left_anti"), products.join(bought, PRODUCT, "left_semi"), PRODUCT)
    return materialize(near_c), materialize(near_p)


def _won(c="predicted"):
    return F.when(F.col(c) == "True", 1).otherwise(0).cast("bigint")


def _longs(df):
    return df.withColumns({"outcome": F.col("outcome").cast("bigint"), "imputed": F.col("imputed").cast("bigint")})


@query
def impute_predict(spark, root):
    customers = t.table(spark, root, "customer").select(F.col("c_custkey").cast("string").alias(CUSTOMER))
    names = fr.curated(spark, root).select(PRODUCT).unionByName(t.catalog(spark, root).select(F.col("srp_1_desc").alias(PRODUCT)))
    requests = jn.cross_score_grid(customers, names)
    scored = materialize(fr.scored_sales(spark, root))
    return _longs(ln.impute_predict(requests, _valued(scored, _won()), *_near_ids(spark, root, scored)))


@query
def score_grid(spark, root):
    scored, after = _scored_halves(spark, root)
    requests = jn.cross_score_grid(after, _active(spark, root))
    return _longs(ln.impute_predict(requests, _valued(scored, _won()), *_near_ids(spark, root, scored)))


@query
def impute_accuracy(spark, root):
    scored, after = _scored_halves(spark, root)
    truth = after.groupBy(*PAIR).agg(F.max(F.when(F.col("truth") == "True", 1).otherwise(0)).alias("truth"))
    predicted = ln.impute_predict(truth, _valued(scored, _won()), *_near_ids(spark, root, scored))
    return ln.impute_accuracy(predicted.join(truth, PAIR)).withColumns(six("accuracy"))


@query
def permutation_importance(spark, root):
    rows = _win_train(spark, root)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in ds.FEATURES])
    return ln.permutation_importance(_win(rows), rows, F.col("iswon") == "True", WIN_FEATURES, key)


@query
def model_comparison(spark, root):
    return ln.model_comparison(_propensity_rows(spark, root), F.col("outcome"), PROPENSITY_FEATURES, _row_key(), k=5)


# recommendations


@query
def rate_pairs(spark, root):
    """Pairs with their number of rated rows, and whether every rating lies in [-1, 1]."""
    train = _win_train(spark, root)
    rated = rc.rate_pairs(_win(train), train)
    return rated.groupBy(*PAIR).agg(F.count("rating").alias("n"), F.max(F.abs("rating") <= 1).alias("in_range"))


def _signed(spark, root):
    return cl.rating_from_probability(fr.scored_sales(spark, root), "win_prob", "predicted", "truth")


@query
def cluster_ratings(spark, root):
    return rc.cluster_ratings(_signed(spark, root), fr.customer_clusters(spark, root)).withColumns(six("rating"))


def _regions(spark, root):
    customer, nation = t.table(spark, root, "customer"), t.table(spark, root, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias(CUSTOMER), F.col("n_regionkey").cast("bigint").alias("cluster")
    )


@query
def als_fill(spark, root):
    """Rated cells of each cluster, and whether their factorised ratings are closer than half the range of ratings."""
    ratings = materialize(rc.cluster_ratings(_signed(spark, root), _regions(spark, root)))
    scored = rc.als_fill(ratings).score(ratings)
    cells = scored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_cells"))
    return rc.factorisation_rmse(scored, ratings).join(cells, "cluster").select("cluster", "n_cells", (F.col("rmse") < 1).alias("close"))


@query
def logistic_mf(spark, root):
    """Liked and other pairs of each cluster, and whether liked ones have the higher mean log-odds."""
    ratings = materialize(rc.cluster_ratings(_signed(spark, root), _regions(spark, root)))
    both = rc.logistic_mf(ratings).withColumnRenamed("rating", "score").join(ratings, ["cluster", *PAIR])
    liked = F.col("rating") > 0
    return both.groupBy("cluster").agg(
        F.count_if(liked).alias("n_liked"), F.count_if(~liked).alias("n_other"),
        (F.avg(F.when(liked, F.col("score"))) > F.avg(F.when(~liked, F.col("score")))).alias("apart"),
    )


#: Factor counts tried by ``rmse_delta``: doubling up to the default of ``als_fill``, all at its full iterations.
FACTORS = (3, 6, 12, 25, 50)


@query
def rmse_delta(spark, root):
    """Error of the factorisation for growing factor counts, and what each step gains."""
    ratings = materialize(rc.cluster_ratings(_signed(spark, root), _regions(spark, root)))
    tried = []
    for factors, fitted in rc.als_sweep(ratings, FACTORS).items():
        error = rc.factorisation_rmse(fitted.score(ratings), ratings)
        tried.append(error.agg(F.avg("rmse").alias("rmse")).select(F.lit(factors).alias("factors"), "rmse"))
    return wn.rmse_delta(reduce(DataFrame.unionByName, tried))


@query
def factorisation_rmse(spark, root):
    actual = rc.cluster_ratings(_signed(spark, root), fr.customer_clusters(spark, root))
    predicted = fr.pair_ratings(spark, root).join(fr.customer_clusters(spark, root), CUSTOMER)
    return rc.factorisation_rmse(predicted, actual).withColumns(six("rmse"))


def _cell_ratings(spark, root):
    """Ratings of all rated pairs, with their customers' clusters."""
    return fr.pair_ratings(spark, root).join(fr.customer_clusters(spark, root), CUSTOMER)


@query
def fill_unseen_customers(spark, root):
    """Ratings of the customers that have none."""
    customers = clustered_customers(spark, root)
    return rc.fill_unseen_customers(_cell_ratings(spark, root), customers, CUSTOMER_WEIGHTS).withColumns(six("rating"))


@query
def fill_unseen_customers_by_distance(spark, root):
    filled = rc.fill_unseen_customers(
        _cell_ratings(spark, root), clustered_customers(spark, root), CUSTOMER_WEIGHTS, weighting="distance"
    )
    return filled.withColumns(six("rating"))


@query
def fill_unseen_products(spark, root):
    """Ratings of inactive products from the active ones: which products count as rated is the query's parameter."""
    rated = fr.pair_ratings(spark, root).join(fr.customer_clusters(spark, root), CUSTOMER)
    rated = rated.join(_active(spark, root).select(PRODUCT), PRODUCT, "left_semi")
    pairs = di.mirrored(product_distances(spark, root))
    return rc.fill_unseen_products(rated, fr.product_clusters(spark, root), pairs).withColumns(six("rating"))


@query
def replacement_rollup(spark, root):
    return rc.replacement_rollup(fr.pair_ratings(spark, root), fr.curated(spark, root)).withColumns(six("rating"))


def _recommend_inputs(spark, root):
    curated = fr.curated(spark, root)
    matrix = fr.pair_ratings(spark, root)
    grid = jn.cross_score_grid(matrix, curated)
    propensity = grid.select(
        *PAIR,
        (F.substr(PRODUCT, F.lit(7)).cast("bigint") % 2).alias("outcome"),
        (F.col(CUSTOMER).cast("bigint") % 2).alias("imputed"),
    )
    return matrix, propensity, fr.sales_before(spark, root), curated, fr.SERVICES


@query
def recommend(spark, root):
    return rc.recommend(*_recommend_inputs(spark, root)).withColumns(six("rating"))


@query
def recommend_with_remark(spark, root):
    return rc.recommend_with_remark(*_recommend_inputs(spark, root), top=10)


@query
def mrr_rows(spark, root):
    return rk.mrr_rows(fr.pair_ratings(spark, root), fr.sales_after(spark, root), fr.curated(spark, root)).withColumns(
        six("reciprocal_rank")
    )


def _pair_rows(spark, root):
    """Purchases after the cutoff with the rank by quantity before it: one pass over the sales gives both."""
    sales, before = t.sales(spark, root), F.col("dtl_invoice_dt") <= F.lit(fr.CUTOFF)
    pairs = sales.groupBy(*PAIR).agg(F.sum(F.when(before, F.col("dtl_qty_ordered"))).alias("qty"), F.count_if(~before).alias("n"))
    pairs = materialize(pairs)
    return rk.mrr_rows(fr.share_ratings(pairs.where("qty IS NOT NULL")), pairs.where("n > 0"), fr.curated(spark, root), keep=("n",))


@query
def mrr(spark, root):
    return rk.mrr(_pair_rows(spark, root)).withColumns(six("mrr"))


@query
def mrr_by_location(spark, root):
    return rk.mrr_by_location(_pair_rows(spark, root)).withColumns(six("mrr"))


@query
def precision_recall_at_k(spark, root):
    return rk.precision_recall_at_k(_pair_rows(spark, root), 10).withColumns(six("precision", "recall"))


@query
def customer_lookup(spark, root):
    ids = t.sales(spark, root).select(CUSTOMER).distinct()
    return rc.customer_lookup(ids, t.baseline(spark, root))


@query
def propensity_lookup(spark, root):
    scored, after = _scored_halves(spark, root)
    requests = materialize(after.select(*PAIR).distinct())
    near_ids = _near_ids(spark, root, scored)
    both = ln.impute_predict(requests, scored.select(*PAIR, _won().alias("near"), F.col("win_prob").alias("win")), *near_ids, values=("near", "win"))
    return rc.propensity_lookup(both.select(*PAIR, F.col("near").alias("outcome"), "imputed", F.col("win").cast("double").alias("win_prob")))


@query
def coverage_stats(spark, root):
    return rc.coverage_stats(rc.cluster_ratings(_signed(spark, root), fr.customer_clusters(spark, root)))


@query
def end_to_end(spark, root):
    """Mean reciprocal rank by location of the whole chain: win model, signed ratings, customer clusters from all features,
    factorisation per cluster, ratings of customers without any, replaced products, ranks against later purchases.

    ``n_pairs`` counts the pairs bought after the cutoff that have a rank."""
    train = _win_train(spark, root)
    rated = agg.mean_rating(rc.rate_pairs(_win(train), train))
    customers = materialize(clustered_by_features(spark, root))
    ratings = materialize(rc.cluster_ratings(rated, customers.select(CUSTOMER, "cluster")))
    products = fr.curated(spark, root).count()
    scored = materialize(rc.als_fill(ratings, rank=8, iters=10).top(products))
    unseen = rc.fill_unseen_customers(scored, customers, CUSTOMER_WEIGHTS)
    labels = cu.ward_cutoff(product_distances(spark, root), 0.7).withColumnRenamed("id", PRODUCT)
    known = scored.unionByName(unseen)
    more = rc.fill_unseen_products(known, labels, di.mirrored(product_distances(spark, root)))
    matrix = rc.replacement_rollup(known.unionByName(more).select(*PAIR, "rating"), fr.curated(spark, root))
    rows = materialize(rk.pair_rows(matrix, fr.sales_after(spark, root), fr.curated(spark, root)))
    found = rows.groupBy("location").agg(F.count(F.lit(1)).alias("n_pairs"))
    return rk.mrr_by_location(rows).join(found, "location").select("location", "n_pairs", F.round("mrr", 6).alias("mrr"))

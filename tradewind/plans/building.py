"""Registered queries: named datasets, distances and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import clustering as cu
from ..operators import distance as di
from ..operators import joins as jn
from ..operators import mixed
from ..operators import similar
from ..settings import CUSTOMER, PRODUCT
from ..sources import tables as t
from ..sources.stages import materialize
from . import datasets as ds
from . import frames as fr
from .relational import _sources, six

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# datasets


@query
def customer_interactions(spark, root):
    return ds.customer_interactions(_sources(spark, root))


@query
def customer_details(spark, root):
    df = ds.customer_details(_sources(spark, root))
    lists = ["sales_list", "salesforce_list", "rental_list"]
    return df.withColumns({c: F.array_join(c, "|") for c in lists} | six("purchase_per_year")).drop(*[f"{c}_rows" for c in lists])


@query
def product_details(spark, root):
    df = ds.product_details(fr.curated(spark, root), t.catalog(spark, root), fr.sales_before(spark, root), fr.opps_before(spark, root), t.rentals(spark, root))
    return df.withColumns(six("avg_order_amount", "avg_sales_per_year"))


@query
def prediction_train(spark, root):
    return ds.prediction_train(t.sales(spark, root, geography=True), t.opportunities(spark, root))


@query
def prediction_test_filled_from_all(spark, root):
    """The test rows when gaps are filled from all rows, those after the cutoff included."""
    return ds.prediction_test(t.sales(spark, root, geography=True), t.opportunities(spark, root), fill_after=True)


@query
def prediction_test(spark, root):
    return ds.prediction_test(t.sales(spark, root, geography=True), t.opportunities(spark, root))


@query
def propensity_train(spark, root):
    df = ds.propensity_train(t.sales(spark, root, geography=True), literal=True)
    return df.withColumns(six("gap_mean", "gap_std")).withColumn("outcome", F.col("outcome").cast("bigint"))


@query
def propensity_test(spark, root):
    return ds.propensity_test(t.sales(spark, root)).withColumn("outcome", F.col("outcome").cast("bigint"))


# distances

PRODUCT_WEIGHTS = {"product_type": 1, "location": 2, "avg_order_amount": 3, "sales_list": 4}
CUSTOMER_WEIGHTS = {"customer_class": 1, "customer_type": 2, "active_cust_yn": 3, "customer_price_group": 2}


def _products(spark, root):
    amounts = agg.avg_order_amount(fr.sales_before(spark, root), PRODUCT)
    return fr.curated(spark, root).select(PRODUCT, "product_type", "location", "active").join(amounts, PRODUCT, "left")


def _buyers(spark, root):
    return agg.members(fr.sales_before(spark, root), PRODUCT, CUSTOMER)


def product_pairs(spark, root):
    """The product pair table as a stage of its own: small, and read several times downstream."""
    pairs = di.pairwise_features(
        _products(spark, root),
        PRODUCT,
        {"product_type": di.MATCHING, "location": di.MATCHING, "avg_order_amount": di.NUMERIC},
        {"sales_list": _buyers(spark, root)},
    )
    return materialize(pairs)


def product_distances(spark, root):
    return di.weighted_distance(product_pairs(spark, root), PRODUCT_WEIGHTS)


def product_labels(spark, root):
    return fr.product_clusters(spark, root).withColumnRenamed(PRODUCT, "id")


def clustered_customers(spark, root):
    return t.baseline(spark, root).join(fr.customer_clusters(spark, root), CUSTOMER)


@query
def dist_numeric(spark, root):
    return di.dist_numeric(_products(spark, root), PRODUCT, "avg_order_amount").withColumns(six("d"))


@query
def dist_matching(spark, root):
    return di.dist_matching(_products(spark, root), PRODUCT, "location")


@query
def dist_jaccard(spark, root):
    return di.dist_jaccard(_products(spark, root), PRODUCT, _buyers(spark, root)).withColumns(six("d"))


@query
def pairwise_features(spark, root):
    return product_pairs(spark, root).withColumns(six("avg_order_amount", "sales_list"))


@query
def weighted_distance(spark, root):
    return product_distances(spark, root).withColumns(six("d"))


@query
def nearest_entity(spark, root):
    products = fr.curated(spark, root)
    unknown, known = products.where("active = 'N'"), products.where("active = 'Y'")
    return di.nearest_entity(product_distances(spark, root), unknown, known, PRODUCT).withColumns(six("d"))


@query
def nearest_by_profile(spark, root):
    base = t.baseline(spark, root)
    known = base.join(fr.opps_before(spark, root).where("iswon = 'False'").select(CUSTOMER).distinct(), CUSTOMER, "left_semi")
    unknown = base.join(known, CUSTOMER, "left_anti")
    return di.nearest_by_profile(unknown, known, CUSTOMER, CUSTOMER_WEIGHTS).withColumns(six("d"))


@query
def affinity_weights(spark, root):
    products = fr.curated(spark, root)
    unknown, known = products.where("active = 'N'"), products.where("active = 'Y'")
    return di.affinity_weights(product_distances(spark, root), unknown, known, PRODUCT).withColumns(six("w"))


@query
def wcss(spark, root):
    measured = cu.wcss(product_distances(spark, root), product_labels(spark, root))
    return measured.withColumns(six("wcss"))


@query
def silhouette(spark, root):
    return cu.silhouette(product_distances(spark, root), product_labels(spark, root)).withColumns(six("score"))


@query
def silhouette_by_profile(spark, root):
    return cu.silhouette_by_profile(clustered_customers(spark, root), CUSTOMER, CUSTOMER_WEIGHTS).withColumns(six("score"))


@query
def wcss_by_profile(spark, root):
    return cu.wcss_by_profile(clustered_customers(spark, root), CUSTOMER_WEIGHTS).withColumns(six("wcss"))


@query
def cluster_summary(spark, root):
    return cu.cluster_summary(product_distances(spark, root), product_labels(spark, root), PRODUCT_WEIGHTS, 2.0)


TUNED = ["product_type", "location", "sales_list"]


@query
def best_run_weights(spark, root):
    tried = {f"trial {i:02d}": {f: float((i * (3 + n) + n) % 10 + 1) for n, f in enumerate(TUNED)} for i in range(20)}
    runs = cu.weighted_runs(product_pairs(spark, root), product_labels(spark, root), tried)
    return cu.best_run_weights(runs, list(PRODUCT_WEIGHTS)).withColumns(six("weight"))


@query
def ward_cutoff(spark, root):
    return cu.ward_cutoff(product_distances(spark, root), 0.7)


@query
def ward_by_profile(spark, root):
    """All baseline customers."""
    return cu.ward_by_profile(t.baseline(spark, root), CUSTOMER, CUSTOMER_WEIGHTS, 2.0)


@query
def forward_feature_selection(spark, root):
    return cu.forward_feature_selection(product_pairs(spark, root), list(PRODUCT_WEIGHTS), 0.7)


@query
def weight_search(spark, root):
    """Weights tried for the three features that are selected first."""
    pairs = product_pairs(spark, root)
    steps = cu.forward_feature_selection(pairs, list(PRODUCT_WEIGHTS), 0.7, top_feature=3)
    features = [r.feature for r in steps.orderBy("step").collect()]
    runs = cu.weight_search(pairs, features, 0.7, n_trials=10, seed=1)
    return runs.select("trial", F.to_json("weights").alias("weights"), "wcss", "n_clusters")


@query
def cluster_affinity(spark, root):
    return cu.cluster_affinity(product_distances(spark, root), 4)


#: Every customer feature that the tables supply, with its metric, and its weight in the registered queries.
CUSTOMER_FEATURES = {
    "customer_class": di.MATCHING, "customer_type": di.MATCHING, "active_cust_yn": di.MATCHING, "customer_price_group": di.MATCHING, "hospital_type": di.MATCHING,
    "purchase_per_year": di.NUMERIC, "avg_order_amount": di.NUMERIC, "staffed_beds": di.NUMERIC, "net_income": di.NUMERIC,
    "sales_list": di.JACCARD, "won_list": di.JACCARD, "lost_list": di.JACCARD, "rental_list": di.JACCARD,
}
ALL_WEIGHTS = {c: 1.0 + i % 4 for i, c in enumerate(CUSTOMER_FEATURES)}


def customer_features(spark, root):
    """Baseline customers with categories, rates, hospital figures and product lists."""
    before = fr.sales_before(spark, root)
    won = agg.collect_products(fr.opps_before(spark, root).where("iswon = 'True'")).select(CUSTOMER, F.col("items").alias("won_list"))
    lost = agg.collect_products(fr.opps_before(spark, root).where("iswon = 'False'")).select(CUSTOMER, F.col("items").alias("lost_list"))
    rented = agg.collect_products(t.rentals(spark, root)).select(CUSTOMER, F.col("items").alias("rental_list"))
    lists = agg.collect_products(before).select(CUSTOMER, F.col("items").alias("sales_list"))
    hospitals = t.crosswalk(spark, root).select(CUSTOMER, "definitive_id")
    # A row per customer in each: merged, as a compressed file below the broadcast threshold is many times that in the driver.
    entities = t.baseline(spark, root)
    for table in (agg.purchase_rate(before, CUSTOMER), agg.avg_order_amount(before, CUSTOMER), lists, won, lost, rented, hospitals):
        entities = entities.join(table.hint("merge"), CUSTOMER, "left")
    entities = jn.enrich_left(entities, t.external(spark, root), "definitive_id", ["staffed_beds", "net_income", "hospital_type"])
    return materialize(entities.fillna("none", ["hospital_type"]))


@query
def approx_similar_pairs(spark, root):
    """The five customers that are most like each by the kinds of goods they bought and rented."""
    bought = fr.sales_before(spark, root).select(CUSTOMER, F.concat(F.lit("bought "), "srp_1_desc").alias("element"))
    rented = t.rentals(spark, root).select(CUSTOMER, F.concat(F.lit("rented "), PRODUCT).alias("element"))
    return similar.approx_similar_pairs(bought.union(rented), CUSTOMER).withColumns(six("d"))


@query
def silhouette_mixed(spark, root):
    """Silhouette of customers over all features, categories, numbers and lists."""
    entities = customer_features(spark, root).join(fr.customer_clusters(spark, root).hint("merge"), CUSTOMER)
    return mixed.silhouette_mixed(entities, CUSTOMER, ALL_WEIGHTS, CUSTOMER_FEATURES).withColumns(six("score"))


def clustered_by_features(spark, root):
    """Baseline customers with a ``cluster`` from their categories, rates and product lists."""
    entities = customer_features(spark, root)
    clusters = cu.cluster_vectors(
        entities,
        CUSTOMER,
        ["customer_class", "customer_type", "active_cust_yn", "customer_price_group", "hospital_type"],
        ["purchase_per_year", "avg_order_amount", "staffed_beds", "net_income"],
        ["sales_list", "won_list", "lost_list", "rental_list"],
        10,
    )
    return entities.join(clusters.withColumnRenamed("id", CUSTOMER), CUSTOMER)


@query
def cluster_vectors(spark, root):
    return clustered_by_features(spark, root).select(F.col(CUSTOMER).alias("id"), "cluster")

"""Collaborative filtering per customer cluster and the recommendations made from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from ..settings import CUSTOMER, PAIR, PRODUCT
from .cleaning import isin_filter, rating_from_probability, remark_labels, truncate_decimals
from .distance import SMALLEST, agreement_keys, agreements, per_set, with_profile
from .implicit import ImplicitBlocks, ImplicitFactors
from .joins import drop_unowned_services, enrich_left
from .learning import Classifier, batch_predict
from .logistic import logistic_factors
from .sets import top_k_products


#: Ratings as they are added: 15 digits after the point, as many as a double near 1 is sure of.
EXACT = "decimal(28,15)"


def rate_pairs(classifier: Classifier, train: DataFrame, truth: str = "iswon") -> DataFrame:
    """Signed rating of every training row from its win probability."""
    scored = batch_predict(classifier, train, probability=True)
    predicted = scored.withColumn("predicted", F.when(F.col("predicted") == 1, "True").otherwise("False"))
    return rating_from_probability(predicted, "win_prob", "predicted", truth)


def cluster_ratings(ratings: DataFrame, labels: DataFrame) -> DataFrame:
    """``[cluster, customer, product, rating]``: mean rating per pair, for customers with a cluster.

    Ratings are averaged per pair before the labels are joined.  They are added as decimals: sums of doubles depend on the order
    of the rows, and a pair whose ratings cancel out would be liked or not by the last bit."""
    exact = F.avg(F.col("rating").cast(EXACT)).cast("double").alias("rating")
    means = ratings.where(F.col("rating").isNotNull()).groupBy(*PAIR).agg(exact)
    return means.join(labels.where(F.col("cluster").isNotNull()), CUSTOMER).select("cluster", *PAIR, "rating")


def als_fill(ratings: DataFrame, rank: int = 50, iters: int = 30, seed: int = 0) -> ImplicitFactors:
    """Implicit factorisations of ``[cluster, customer, product, rating]``, kept as factors.

    One factorisation per cluster, as clusters must not influence each other; all are fitted side by side.  A customer or
    product without any positive rating is left out of the fit and scored zero.  Ratings are made for requested pairs or
    the best products only, never for the whole table."""
    return als_sweep(ratings, (rank,), iters, seed)[rank]


def als_sweep(ratings: DataFrame, ranks: tuple[int, ...], iters: int = 30, seed: int = 0) -> dict[int, ImplicitFactors]:
    """``als_fill`` for several ranks; the ratings are dealt to blocks once."""
    blocks = ImplicitBlocks(ratings)
    return {rank: blocks.fit(rank, iters, seed) for rank in ranks}


def logistic_mf(ratings: DataFrame, factors: int = 8, iters: int = 8, seed: int = 0) -> DataFrame:
    """``[cluster, customer, product, rating]``: log-odds that a rated pair is liked, by a logistic factorisation whose
    customers' factors never leave their blocks (``logistic_factors``)."""
    return logistic_factors(ratings, factors, iters, seed).rate(ratings)


def factorisation_rmse(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """``[cluster, rmse]``: root of the mean over products of the mean squared error of known cells."""
    both = actual.withColumnRenamed("rating", "actual").join(predicted, ["cluster", *PAIR])
    error = (F.col("rating") - F.col("actual")) * (F.col("rating") - F.col("actual"))
    by_product = both.groupBy("cluster", PRODUCT).agg(F.avg(error).alias("mse"))
    return by_product.groupBy("cluster").agg(F.sqrt(F.avg("mse")).alias("rmse"))


def fill_unseen_customers(
    ratings: DataFrame, customers: DataFrame, features: Mapping[str, float], weighting: str = "inverse"
) -> DataFrame:
    """Ratings for cluster members that have none: the mean of the cluster's rated members weighted
    by closeness (``"inverse"``) or by distance (``"distance"``), ``[cluster, customer, product, rating]``.

    ``ratings`` is ``[cluster, customer, product, rating]``; ``customers`` is ``[customer, cluster, *features]`` with
    categorical features.  Ratings are summed per value key of each feature set; a weighted sum over all rated members
    is then a sum over the sets, with signs that leave every member counted once, at its own distance."""
    cols, sets = list(features), agreements(features)
    weigh = lambda d: 1 / max(d, SMALLEST) if weighting == "inverse" else max(d, SMALLEST)
    signed = [
        sum((-1) ** (len(outer) - len(inner)) * weigh(d) for inner, d in sets if set(inner) <= set(outer)) for outer, _ in sets
    ]
    cells = with_profile(customers, cols)
    targets = cells.join(ratings.select(CUSTOMER).distinct(), CUSTOMER, "left_anti")
    same = [s for s, _ in sets]
    sums = (
        ratings.join(cells.select(CUSTOMER, "profile", *cols), CUSTOMER)
        .groupBy("cluster", "profile", *cols, PRODUCT)
        .agg(F.sum("rating").alias("total"), F.count("rating").alias("n"))
    )
    sums = agreement_keys(sums, same, ["cluster", PRODUCT, "total", "n"]).groupBy("cluster", "s", "v", PRODUCT).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    wanted = agreement_keys(targets.select("cluster", "profile", *cols).distinct(), same, ["cluster", "profile"])
    w = per_set(signed)
    filled = (
        wanted.join(sums, ["cluster", "s", "v"])
        .groupBy("cluster", "profile", PRODUCT)
        .agg((F.sum(w * F.col("total")) / F.sum(w * F.col("n"))).alias("rating"))
    )
    return targets.select("cluster", CUSTOMER, "profile").join(filled, ["cluster", "profile"]).select("cluster", *PAIR, "rating")


def fill_unseen_products(ratings: DataFrame, labels: DataFrame, pairs: DataFrame, weighting: str = "inverse") -> DataFrame:
    """Ratings of products without any, from the rated products of the same product cluster.

    ``labels`` is ``[product, cluster]``, ``pairs`` the product distances in both directions as
    ``[a, b, d]``.  The weight table is bounded by the square of the product list."""
    rated = ratings.select(PRODUCT).distinct()
    known = labels.join(rated, PRODUCT, "left_semi").select(F.col(PRODUCT).alias("b"), F.col("cluster").alias("shelf"))
    missing = labels.join(rated, PRODUCT, "left_anti").select(F.col(PRODUCT).alias("a"), F.col("cluster").alias("shelf"))
    near = F.greatest(F.col("d"), F.lit(SMALLEST))
    weights = (
        pairs.join(missing, "a")
        .join(known, ["b", "shelf"])
        .select("a", F.col("b").alias(PRODUCT), (1 / near if weighting == "inverse" else near).alias("w"))
    )
    mean = F.sum(F.col("w") * F.col("rating")) / F.sum("w")
    return (
        ratings.join(weights, PRODUCT)
        .groupBy("cluster", CUSTOMER, "a")
        .agg(mean.alias("rating"))
        .select("cluster", CUSTOMER, F.col("a").alias(PRODUCT), "rating")
    )


def replacement_rollup(ratings: DataFrame, curated: DataFrame) -> DataFrame:
    """Products renamed to their successor, ratings of products that meet averaged."""
    renamed = enrich_left(ratings, curated, PRODUCT, ["updated"]).withColumn(PRODUCT, F.coalesce("updated", PRODUCT))
    return renamed.groupBy(*PAIR).agg(F.avg("rating").alias("rating"))


def recommend(
    matrix: DataFrame,
    propensity: DataFrame,
    owned: DataFrame,
    curated: DataFrame,
    services: dict[str, list[str]],
    customers: list[str] | None = None,
    top: int = 0,
    remark: bool = True,
    replacement: bool = True,
    curated_only: bool = True,
    service_rule: bool = True,
) -> DataFrame:
    """Ranked products of all customers at once, ``[customer, product, rating, outcome, imputed, pos]``.

    ``propensity`` is ``[customer, product, outcome, imputed]``.  Without ``remark`` the last two
    are not looked up and left out of the order.  ``customers`` restricts the run before anything
    is joined."""
    recs = matrix.select(*PAIR, "rating")
    if customers is not None:
        recs = recs.where(F.col(CUSTOMER).isin(customers))
    if curated_only:
        recs = isin_filter(recs, curated, PRODUCT)
    if replacement:
        recs = replacement_rollup(recs, curated)
    if remark:
        recs = recs.join(propensity.select(*PAIR, "outcome", "imputed"), PAIR, "left")
    else:
        recs = recs.withColumns({"outcome": F.lit(-1), "imputed": F.lit(-1)})
    if service_rule:
        recs = drop_unowned_services(recs, owned, services)
    return top_k_products(recs, top)


def recommend_with_remark(*args, remark: bool = True, **options) -> DataFrame:
    """``recommend`` under display names; ratings cut to four decimals."""
    ranked = truncate_decimals(remark_labels(recommend(*args, remark=remark, **options)), "rating", 4)
    shown = ranked.select(
        F.col(CUSTOMER).alias("Customer"), F.col(PRODUCT).alias("Product"), F.col("rating").alias("Rating"), "Remark", "History", "pos"
    )
    return shown if remark else shown.drop("Remark", "History")


def customer_lookup(ids: DataFrame, customers: DataFrame) -> DataFrame:
    named = enrich_left(ids.select(CUSTOMER), customers, CUSTOMER, ["customer_name"])
    known = customers.select(CUSTOMER).distinct().withColumn("known", F.lit(True))
    name = F.when(F.col("known"), F.col("customer_name")).otherwise(scoring.NO_NAME)
    return named.join(known, CUSTOMER, "left").select(CUSTOMER, name.alias("customer_name"))


def propensity_lookup(near: DataFrame, win: DataFrame | None = None) -> DataFrame:
    """``[customer, product, Remark, History, win_prob]``: the remark is blank below even odds.

    ``near`` and ``win`` are scored pairs (``[.., outcome, imputed]``); ``win`` holds probabilities, unless ``near`` has them as
    ``win_prob``."""
    prob = scoring.truncated(F.col("win_prob"), 2)
    both = remark_labels(near)
    if win is not None:
        both = both.join(win.select(*PAIR, F.col("outcome").cast("double").alias("win_prob")), PAIR)
    return both.select(
        *PAIR, F.when(prob < 0.5, "").otherwise(F.col("Remark")).alias("Remark"), "History", prob.alias("win_prob")
    )


def coverage_stats(matrix: DataFrame) -> DataFrame:
    """How many customers and clusters can be given recommendations."""
    per = matrix.groupBy("cluster", CUSTOMER).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count_distinct(CUSTOMER).alias("n_customers"), F.count_distinct("cluster").alias("n_clusters"))

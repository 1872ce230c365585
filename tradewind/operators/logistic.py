"""Logistic factorisation per cluster, by alternating Newton steps over blocks of customers.

A pair's log-odds are a product's bias, a customer's bias and the product of both factor vectors. Customers are dealt to
blocks once, each with its ratings. In a round the products' factors are sent to the blocks; a block fits its own customers to
them from nothing (a ridge-bounded problem of a few unknowns each), and returns only sums of gradients and curvatures per
product, which Spark adds up. So customers' factors live inside a task for one round, a lost task is simply run again, and what
the driver holds grows with products only: clusters do not influence each other, and are taken in groups that have at most
``MOST`` products together (one cluster at least)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import CUSTOMER, PAIR, PRODUCT
from ..sources.stages import materialize

#: Cells (customers x products) of a block; products of clusters, all together, that are fitted side by side.
CELLS, MOST = 250_000, 200_000
STEPS, RIDGE = 4, 1.0


def _probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _block(r: dict, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Customers' parameters fitted to the products' (bias first), with the cells that are rated and liked."""
    customers, own = np.unique(np.array(r["customers"], object), return_inverse=True)
    rated, liked = np.zeros((len(customers), len(items))), np.zeros((len(customers), len(items)))
    rated[own, r["items"]] = 1
    liked[own, r["items"]] = r["liked"]
    inputs = np.concatenate([np.ones((len(items), 1)), items[:, 1:]], axis=1)
    theta = np.zeros((len(customers), inputs.shape[1]))
    ridge = RIDGE * np.eye(inputs.shape[1])
    for _ in range(STEPS):
        p = _probability(theta @ inputs.T + items[:, 0])
        gradient = (rated * (p - liked)) @ inputs + RIDGE * theta
        curvature = np.einsum("ui,ij,ik->ujk", rated * p * (1 - p), inputs, inputs, optimize=True) + ridge
        theta -= np.linalg.solve(curvature, gradient[:, :, None])[:, :, 0]
    return customers, theta, rated, liked


def _sums(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """For each product of a block the gradient and curvature of its own parameters (bias and factors)."""
    for batch in batches:
        for r in batch.to_pylist():
            items = sent.value[r["part"]]
            _, theta, rated, liked = _block(r, items)
            p = _probability(theta @ np.concatenate([np.ones((len(items), 1)), items[:, 1:]], axis=1).T + items[:, 0])
            inputs = np.concatenate([np.ones((len(theta), 1)), theta[:, 1:]], axis=1)
            gradient = (rated * (p - liked)).T @ inputs
            curvature = np.einsum("ui,uj,uk->ijk", rated * p * (1 - p), inputs, inputs, optimize=True)
            flat = np.concatenate([gradient, curvature.reshape(len(items), -1)], axis=1)
            yield pa.record_batch([pa.array(np.full(len(items), r["part"]), pa.int32()), pa.array(np.arange(len(items)), pa.int32()), pa.array(flat.tolist(), pa.list_(pa.float64()))], names=["part", "item", "sums"])


def _scores(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """The parameters of each customer, fitted to the last factors of the products."""
    for batch in batches:
        for r in batch.to_pylist():
            customers, theta, _, _ = _block(r, sent.value[r["part"]])
            yield pa.record_batch([pa.array(np.full(len(customers), r["part"]), pa.int32()), pa.array(customers, pa.string()), pa.array(theta.tolist(), pa.list_(pa.float64()))], names=["part", "customer", "theta"])


def _fit(blocks: DataFrame, sizes: dict[int, int], factors: int, iters: int, seed: int) -> Broadcast:
    """The products' parameters of each part, after ``iters`` rounds."""
    context, width = blocks.sparkSession.sparkContext, factors + 1
    known = {part: np.random.default_rng([seed, part]).normal(0, 0.3, (n, width)) * np.append(0, np.ones(factors)) for part, n in sizes.items()}
    sent = context.broadcast(known)
    for _ in range(iters):
        sums = blocks.mapInArrow(partial(_sums, sent=sent), "part int, item int, sums array<double>").groupBy("part", "item")
        rows = sums.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width + width * width)]).toPandas().to_numpy(np.float64)
        moved = {part: x.copy() for part, x in known.items()}
        for row in rows:
            part, item, gradient, curvature = int(row[0]), int(row[1]), row[2 : 2 + width], row[2 + width :].reshape(width, width)
            moved[part][item] -= np.linalg.solve(curvature + RIDGE * np.eye(width), gradient + RIDGE * known[part][item])
        known = moved
        sent = context.broadcast(known)
    return sent


class LogisticFactors:
    """Parameters of customers ``[cluster, customer, theta]`` and products ``[cluster, product, phi]``, both DataFrames."""

    def __init__(self, customers: DataFrame, products: DataFrame):
        self.customers, self.products = customers, products

    def rate(self, pairs: DataFrame) -> DataFrame:
        """``[cluster, customer, product, rating]``: log-odds of the pairs; 0 for a customer or product that has no parameters."""
        both = pairs.select("cluster", *PAIR).join(self.customers, ["cluster", CUSTOMER], "left").join(self.products, ["cluster", PRODUCT], "left")
        factors = F.zip_with(F.slice("theta", 2, F.size("theta")), F.slice("phi", 2, F.size("phi")), lambda x, y: x * y)
        odds = F.aggregate(factors, F.get("theta", F.lit(0)) + F.get("phi", F.lit(0)), lambda s, x: s + x)
        return both.select("cluster", *PAIR, F.coalesce(odds, F.lit(0.0)).alias("rating"))


def logistic_factors(ratings: DataFrame, factors: int = 8, iters: int = 8, seed: int = 0) -> LogisticFactors:
    """Fit ``[cluster, customer, product, rating]``; a pair is liked if its rating is above 0."""
    spark = ratings.sparkSession
    rows = materialize(ratings.dropna(subset=["cluster", *PAIR]).groupBy("cluster", *PAIR).agg(F.max(F.col("rating") > 0).cast("int").alias("liked")))
    shelf = rows.select("cluster", PRODUCT).distinct().orderBy("cluster", PRODUCT).collect()  # products of a cluster: a dimension
    clusters, items = {}, []
    for r in shelf:
        own = clusters.setdefault(r.cluster, [len(clusters), 0])
        items.append((own[0], r[PRODUCT], own[1]))
        own[1] += 1
    parts = spark.createDataFrame([(c, p, n) for c, (p, n) in clusters.items()], "cluster {}, part int, width int".format(ratings.schema["cluster"].dataType.simpleString()))
    coded = rows.join(parts, "cluster").join(spark.createDataFrame(items, f"part int, {PRODUCT} string, item int"), ["part", PRODUCT])
    people = rows.groupBy("cluster").agg(F.count_distinct(CUSTOMER).alias("people")).join(parts, "cluster").select("part", F.ceil(F.col("people") * F.col("width") / CELLS).alias("n"))
    dealt = coded.join(people, "part").withColumn("block", F.pmod(F.xxhash64(CUSTOMER), F.col("n")))
    cell = F.struct(F.col(CUSTOMER).cast("string").alias("c"), F.col("item").alias("i"), F.col("liked").alias("l"))
    blocks = dealt.groupBy("part", "block").agg(F.collect_list(cell).alias("cells")).select("part", F.col("cells.c").alias("customers"), F.col("cells.i").alias("items"), F.col("cells.l").alias("liked"))
    blocks = materialize(blocks.repartition("part"))
    groups, held = [{}], 0
    for part, n in clusters.values():
        if groups[-1] and held + n > MOST:
            groups.append({})
            held = 0
        groups[-1][part], held = n, held + n
    if not clusters:
        raise ValueError("no rated pairs")
    customers, products = [], []
    for group in groups:
        own = blocks.where(F.col("part").isin(list(group)))
        sent = _fit(own, group, factors, iters, seed)
        customers.append(own.mapInArrow(partial(_scores, sent=sent), "part int, customer string, theta array<double>"))
        products += [(part, i, x.tolist()) for part, known in sent.value.items() for i, x in enumerate(known)]
    fitted = customers[0]
    for other in customers[1:]:
        fitted = fitted.unionByName(other)
    fitted = materialize(fitted.join(parts, "part").select("cluster", F.col("customer").alias(CUSTOMER), "theta"))
    names = spark.createDataFrame(items, f"part int, {PRODUCT} string, item int").join(parts, "part")
    phi = names.join(spark.createDataFrame(products, "part int, item int, phi array<double>"), ["part", "item"]).select("cluster", PRODUCT, "phi")
    return LogisticFactors(fitted, phi)

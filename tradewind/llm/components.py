"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.sources.stages import materialize


def _towards_least(pairs: DataFrame, keep: str) -> DataFrame:
    """Tie the ``y`` of each ``x`` (those that ``keep`` leaves) to the least id around ``x``."""
    least = pairs.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return pairs.join(least, "x").where(keep).select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """[node, root] for every node of ``edges`` [u, v]: root is the least node that can be reached.

    Each round ties larger neighbours and then smaller neighbours to the least one (two aggregates
    with map-side combining, and joins whose other side is unique); the edge table never grows and is
    written to the shared folder. It ends when the edges stay the same, after a number of rounds that
    grows with the logarithm of the size."""
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select(F.col("v"), F.col("u")))
        large = _towards_least(both, "y > x")
        small = large.distinct()
        down = small.select(F.col("u").alias("x"), F.col("v").alias("y"))
        roots = down.groupBy("x").agg(F.min("y").alias("m"))
        joined = down.join(roots, "x")
        edges = materialize(
            joined.select(F.col("y").alias("u"), F.col("m").alias("v")).union(roots.select("x", "m")).where("u <> v").distinct()
        )
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_003), F.lit(0))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

"""Expressions for ratings, outcomes and their display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display texts of the outcome codes and of the imputation flag.
REMARKS = {
    1: "Near Sale",
    0: "Far Sale",
    -1: "No Remark (Unknown Customer)",
    -2: "No Remark (Unknown Product)",
    -3: "No Remark (Unknown Customer and Product)",
}
KNOWN_PAIR, NEW_PAIR = "Known Pair", "New Pair"
NO_NAME = "No name found in record"


def signed_rating(prob: Column, predicted: Column, truth: Column) -> Column:
    """Confidence in the true class, stretched from [0, 1] to [-1, 1]."""
    return F.when(predicted == truth, prob).otherwise(1 - prob) * 2 - 1


def near(days: Column, limit: int) -> Column:
    """1 when at most ``limit`` days, else 0 (also when unknown)."""
    return F.when(days <= limit, 1).otherwise(0)


def truncated(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return (c * scale).cast("bigint") / scale


def remark(outcome: Column) -> Column:
    chain = None
    for code, text in REMARKS.items():
        is_code = outcome == code
        chain = F.when(is_code, text) if chain is None else chain.when(is_code, text)
    return chain


def history(imputed: Column) -> Column:
    return F.when(imputed == 0, KNOWN_PAIR).otherwise(NEW_PAIR)


# Distances between two entities' values, all in [0, 1].

def numeric_distance(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    finite = ~F.isnan(gap) & (gap < float("inf"))
    return F.coalesce(F.when(finite, gap / (gap + 1)), F.lit(1.0))


def matching_distance(a: Column, b: Column) -> Column:
    return F.when(a == b, 0.0).otherwise(1.0)


def list_distance(a: Column, b: Column) -> Column:
    """Jaccard distance of two arrays; repeats and nulls in them do not count."""
    x, y = F.array_distinct(F.array_compact(a)), F.array_distinct(F.array_compact(b))
    sizes = [F.when(c.isNotNull(), F.size(d)) for c, d in ((a, x), (b, y))]
    return jaccard_distance(F.size(F.array_intersect(x, y)), *sizes)


def jaccard_distance(shared: Column, size_a: Column, size_b: Column) -> Column:
    """From set sizes; a null size is a missing list, at distance 1 from everything."""
    union = size_a + size_b - shared
    return (
        F.when(size_a.isNull() | size_b.isNull(), 1.0)
        .when(union == 0, 0.0)
        .otherwise(1 - shared / union)
    )

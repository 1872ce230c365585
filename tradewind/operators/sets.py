"""Sorting, top-k and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import CUSTOMER, PAIR, PRODUCT


def sort_purchases(df: DataFrame, date: str = "dtl_invoice_dt", number: str = "dtl_invoice_num") -> DataFrame:
    """Rows in (customer, product, date, number) order: a range-partitioned distributed sort, which
    splits a customer with very many rows over several tasks."""
    return df.orderBy(*PAIR, date, number)


def top_k_products(recs: DataFrame, k: int = 10) -> DataFrame:
    """Each customer's best k products (all for k=0): highest rating, then outcome, then pairs that
    are known, then the product name."""
    best = Window.partitionBy(CUSTOMER).orderBy(
        F.col("rating").desc(), F.col("outcome").desc(), F.col("imputed").asc(), F.col(PRODUCT).asc()
    )
    placed = recs.withColumn("pos", F.row_number().over(best).cast("bigint"))
    return placed.where(F.col("pos") <= k) if k else placed


def feature_ranking(df: DataFrame, value: str, name: str = "feature") -> DataFrame:
    """Features by descending weight or importance; one row per feature."""
    return df.withColumn("pos", F.row_number().over(Window.orderBy(F.col(value).desc(), name)).cast("bigint"))


def union_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def union_tagged(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("cutoff_tag", F.lit(t)) for t, df in frames.items()])


def distinct_pairs(df: DataFrame) -> DataFrame:
    return df.select(*PAIR).distinct()


def known_entities(train: DataFrame, paired: DataFrame, key: str) -> DataFrame:
    """``[id, in_train, in_pairs]`` over the union of both id sets."""
    tagged = train.select(F.col(key).alias("id"), F.lit(True).alias("t")).unionByName(
        paired.select(F.col(key).alias("id"), F.lit(False).alias("t"))
    )
    return tagged.groupBy("id").agg(F.bool_or("t").alias("in_train"), F.bool_or(~F.col("t")).alias("in_pairs"))


def sorted_dimension_lists(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)

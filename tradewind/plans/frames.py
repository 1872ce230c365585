"""Shared inputs of the registered queries: the stand-ins that keep model-free checks exact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import cleaning
from ..operators.aggregates import invoices_of
from ..settings import CUSTOMER, DEFAULTS, PAIR, PRODUCT
from ..sources import tables

CUTOFF = DEFAULTS.cutoff
# Which products bring which services in the registered queries.
SERVICES = {"Brand#1": ["Brand#2"], "Brand#3": ["Brand#2"], "Brand#4": ["Brand#4"]}


def curated(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.curated_products(tables.curated_raw(spark, root))


def sales_before(spark: SparkSession, root: str, geography: bool = False) -> DataFrame:
    return cleaning.cutoff_split(tables.sales(spark, root, geography), "dtl_invoice_dt")[0]


def sales_after(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.cutoff_split(tables.sales(spark, root), "dtl_invoice_dt")[1]


def opps_before(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.cutoff_split(tables.opportunities(spark, root), "create_dt")[0]


def invoices_before(spark: SparkSession, root: str, cols: list[str] | None = None) -> DataFrame:
    return invoices_of(sales_before(spark, root), cols or ["dtl_invoice_dt", "dtl_order_dt", "dtl_qty_ordered"])


def invoice_dates(sales: DataFrame) -> DataFrame:
    """Invoices with their date only; an invoice has one date, so a distinct is enough."""
    return sales.select(*PAIR, "dtl_invoice_num", "dtl_invoice_dt").distinct()


def pair_ratings(spark: SparkSession, root: str) -> DataFrame:
    """Stand-in rating: a pair's share of the customer's best product quantity, in [-1, 1]."""
    return share_ratings(sales_before(spark, root).groupBy(*PAIR).agg(F.sum("dtl_qty_ordered").alias("qty")))


def share_ratings(qty: DataFrame) -> DataFrame:
    top = F.max("qty").over(Window.partitionBy(CUSTOMER))
    return qty.select(*PAIR, (F.col("qty") / top * 2 - 1).alias("rating"))


def customer_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Stand-in cluster: the customer's nation."""
    return tables.table(spark, root, "customer").select(
        F.col("c_custkey").cast("string").alias(CUSTOMER), F.col("c_nationkey").cast("bigint").alias("cluster")
    )


def product_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Stand-in cluster: the product number modulo five."""
    return curated(spark, root).select(PRODUCT, (F.col("srp_2_code").cast("bigint") % 5).alias("cluster"))


def scored_sales(spark: SparkSession, root: str) -> DataFrame:
    """Before-cutoff sales rows with a stand-in win probability, prediction and truth."""
    return scored(sales_before(spark, root)).drop("dtl_invoice_dt")


def scored(sales: DataFrame) -> DataFrame:
    """Sales rows with their day and the stand-in win probability, prediction and truth."""
    p = F.round(F.col("total_discount") * 10, 2)
    return sales.select(
        *PAIR,
        "dtl_invoice_dt",
        p.alias("win_prob"),
        F.when(p >= 0.5, "True").otherwise("False").alias("predicted"),
        F.when(F.col("dtl_line_type") == "F", "True").otherwise("False").alias("truth"),
    )


def labelled(spark: SparkSession, root: str) -> DataFrame:
    """The stand-in predictions of the sales rows with their truth."""
    won = lambda c: (F.col(c) == "True").cast("bigint")
    return scored_sales(spark, root).select(won("truth").alias("label"), won("predicted").alias("predicted"))

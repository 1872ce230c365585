"""Business tables (sales, opportunities, rentals, ...) built from the star-schema parquet files.

Every function returns a lazy DataFrame.  Column lists are never written out twice for pruning:
the parquet scan reads only what the final plan needs.  Dimension joins carry no broadcast hint, so
Spark broadcasts a side only when its measured size is under ``autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines that a task joins with their orders, about.
LINES_PER_TASK = 1_000_000


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _day(name: str):
    return F.col(name).cast("date")


def _lines_with_part(spark: SparkSession, root: str, geography: bool = False) -> DataFrame:
    """Lines with their part and order; ``o_number`` is the order's key as text. ``geography=True`` joins customer, nation and region
    to the orders, which are fewer and narrower than their lines.

    A task sorts its lines and orders to join them, and holds its opportunities to group them. Spark by itself gives it parts up to a
    size in compressed bytes, or as many lines as its fixed number of parts makes; so many lines are dealt to more tasks here. They
    are dealt by the text that invoices and opportunities are numbered by, so what is grouped by these numbers is not shuffled again."""
    lines = table(spark, root, "lineitem")
    orders = table(spark, root, "orders")
    part = table(spark, root, "part")
    parts = -(-lines.count() // LINES_PER_TASK)
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    orders = orders.withColumn("o_number", F.col("o_orderkey").cast("string"))
    if geography:
        customer = table(spark, root, "customer")
        nation = table(spark, root, "nation")
        region = table(spark, root, "region")
        orders = (
            orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
    # Orders come last: rows then lie by order, which is what invoices and opportunities are grouped by.
    if parts <= spark.sparkContext.defaultParallelism:  # Spark gives a task fewer
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.withColumn("l_number", F.col("l_orderkey").cast("string")).repartition(parts, "l_number")
    return lines.join(orders.repartition(parts, "o_number"), F.col("l_number") == F.col("o_number"))


def sales(spark: SparkSession, root: str, geography: bool = False) -> DataFrame:
    """Capital sales lines.  ``geography=True`` also joins customer, nation and region attributes;
    leave it off when they are not needed, as an inner join cannot be pruned away."""
    lines = _lines_with_part(spark, root, geography).where(F.col("o_orderstatus").isin("F", "O"))
    columns = [
        F.col("o_custkey").cast("string").alias("customer_num"),
        F.col("p_type").alias("srp_1_desc"),
        F.substr("p_brand", F.lit(7)).alias("srp_2_code"),
        F.col("p_brand").alias("srp_2_desc"),
        F.col("p_name").alias("srp_3_desc"),
        F.col("o_number").alias("dtl_invoice_num"),
        F.col("o_number").alias("dtl_order_num"),
        F.col("l_linenumber").alias("dtl_line_num"),
        _day("o_orderdate").alias("dtl_invoice_dt"),
        _day("o_orderdate").alias("dtl_order_dt"),
        _day("l_shipdate").alias("dtl_actual_ship_dt"),
        F.col("l_quantity").cast("bigint").alias("dtl_qty_ordered"),
        F.col("l_extendedprice").alias("dtl_extended_price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("dtl_unit_price"),
        F.col("p_retailprice").alias("dtl_unit_cost"),
        (F.col("l_discount") + F.lit(0.0)).alias("total_discount"),
        F.col("l_linestatus").alias("dtl_line_type"),
        F.col("l_returnflag").alias("dtl_value_package"),
    ]
    if geography:
        columns += [
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("county"),
            F.col("c_mktsegment").alias("customer_price_group"),
        ]
    return lines.select(*columns)


def opportunities(spark: SparkSession, root: str) -> DataFrame:
    """One opportunity per (order, product), won or lost."""
    lines = _lines_with_part(spark, root).where(F.col("o_orderstatus").isin("F", "P"))
    won = F.col("o_orderstatus") == "F"
    return (
        lines.groupBy("o_custkey", "o_number", "p_brand", "o_orderstatus", "o_orderdate")
        .agg(
            F.min("p_type").alias("family"),
            F.max(_day("l_shipdate")).alias("close_dt"),
            F.round(F.sum("l_extendedprice"), 2).alias("amount"),
        )
        .select(
            F.col("o_custkey").cast("string").alias("customer_num"),
            F.col("o_number").alias("opp_id"),
            F.col("p_brand").alias("srp_2_desc"),
            "family",
            F.when(won, "True").otherwise("False").alias("iswon"),
            F.when(won, "Closed Won").otherwise("Closed Lost").alias("stagename"),
            _day("o_orderdate").alias("create_dt"),
            "close_dt",
            "amount",
        )
    )


def rentals(spark: SparkSession, root: str) -> DataFrame:
    return (
        _lines_with_part(spark, root)
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("o_custkey").cast("string").alias("customer_num"),
            F.col("p_brand").alias("srp_2_desc"),
            F.substr("p_brand", F.lit(7)).alias("srp_2_code"),
            _day("l_shipdate").alias("billing_from_dt"),
            F.col("l_quantity").cast("bigint").alias("bill_days"),
            F.col("l_extendedprice").alias("extended_amount"),
        )
    )


def baseline(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey")
    return (
        table(spark, root, "customer")
        .where(key % 10 != 3)
        .select(
            key.cast("string").alias("customer_num"),
            F.when(key % 17 != 0, F.col("c_name")).alias("customer_name"),
            F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N").alias("active_cust_yn"),
            F.col("c_mktsegment").alias("customer_class"),
            F.concat(F.lit("PG"), (F.col("c_nationkey") % 4).cast("string")).alias(
                "customer_price_group"
            ),
            F.concat(F.lit("T"), (key % 3).cast("string")).alias("customer_type"),
        )
    )


def crosswalk(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey")
    return (
        table(spark, root, "customer")
        .where(key % 2 == 0)
        .select(
            key.cast("string").alias("definitive_id"),
            key.cast("string").alias("customer_num"),
            F.col("c_name").alias("customer_name"),
        )
    )


def external(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        table(spark, root, "supplier")
        .join(table(spark, root, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("string").alias("definitive_id"),
            F.col("s_name").alias("customer_name"),
            F.when(key % 7 != 0, (key % 97).cast("double")).alias("staffed_beds"),
            F.col("s_acctbal").alias("net_income"),
            F.col("r_name").alias("hospital_type"),
        )
    )


def curated_raw(spark: SparkSession, root: str) -> DataFrame:
    """The curated product list as extracted, before cleaning."""
    n = F.substr("p_brand", F.lit(7)).cast("int")
    code = F.lpad(n.cast("string"), 3, "0")
    successor = (n - 20).cast("string")
    brands = table(spark, root, "part").select("p_brand").distinct()
    regions = table(spark, root, "region").select("r_regionkey", "r_name")
    return brands.join(regions, n % 5 == F.col("r_regionkey")).select(
        F.concat(code, F.lit(" "), F.col("p_brand")).alias("code_srp_2_desc"),
        n.cast("string").alias("srp_2_code"),
        F.concat(F.lit("PT"), (n % 4).cast("string")).alias("product_type"),
        F.when(n > 20, "N").otherwise("Y").alias("active"),
        F.when(
            n > 20, F.concat(F.lpad(successor, 3, "0"), F.lit(" Brand#"), successor)
        ).alias("replacement"),
        F.when(n > 20, F.concat(successor, F.lit(".0")))
        .when(n % 2 == 0, "0")
        .alias("replacement_srp_2_code"),
        F.when(n <= 22, F.col("r_name")).otherwise("*BLANK*").alias("location"),
    )


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """The unfiltered product list: every combination of hierarchy levels that occurs."""
    return (
        table(spark, root, "part")
        .select(
            F.col("p_type").alias("srp_1_desc"),
            F.substr("p_brand", F.lit(7)).alias("srp_2_code"),
            F.col("p_brand").alias("srp_2_desc"),
            F.col("p_name").alias("srp_3_desc"),
        )
        .distinct()
    )


def raw_amounts(spark: SparkSession, root: str) -> DataFrame:
    """Line amounts as the dirty text an extract delivers: tokens, percent signs, thousands commas."""
    whole = F.floor("l_extendedprice").cast("bigint")
    thousands = F.floor(F.col("l_extendedprice") / 1000).cast("bigint")
    percent = F.round(F.col("l_discount") * 100, 0).cast("bigint")
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 1, "~")
        .when(F.col("l_linenumber") == 2, "nan")
        .when(F.col("l_linenumber") == 3, F.concat(percent.cast("string"), F.lit("%")))
        .otherwise(
            F.concat(
                thousands.cast("string"),
                F.lit(","),
                F.lpad((whole % 1000).cast("string"), 3, "0"),
            )
        )
        .alias("amount_text"),
    )

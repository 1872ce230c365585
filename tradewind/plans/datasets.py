"""Builders of the named datasets, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import cleaning as cl
from ..operators import joins as jn
from ..operators import sets as st
from ..settings import CUSTOMER, DEFAULTS, INVOICE, PAIR, PRODUCT, Settings
from ..sources.stages import materialize

CODE_AND_NAME = ["srp_2_code", PRODUCT]


def customer_interactions(sources: dict[str, DataFrame]) -> DataFrame:
    """Every customer of any source: where it occurs and its best name."""
    return jn.coalesce_name(jn.presence_full_outer(sources))


def folded(facts: DataFrame, by: list[str]) -> DataFrame:
    """One row per ``by`` with its number of rows ``n``, and of sales also quantity, first and last order day and a name.

    A fact table is read once for it; all that is said about customers follows from this small table, which is written."""
    has, sums = set(facts.columns), [F.count(F.lit(1)).alias("n")]
    if "dtl_order_dt" in has:
        sums += [F.sum("dtl_qty_ordered").alias("dtl_qty_ordered"), F.min("dtl_order_dt").alias("first_dt"), F.max("dtl_order_dt").alias("last_dt")]
    if "customer_name" in has:
        sums.append(F.min(F.nullif("customer_name", F.lit(""))).alias("customer_name"))
    return materialize(facts.groupBy(*by).agg(*sums))


def customer_details(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per interacting customer: attributes, product lists, purchase rate and unique key.

    Each fact table is folded once to one row per customer and product, from which presence, names, lists and rates are
    made; every join is one row to one row on ``customer_num``."""
    sales, opps, rentals = folded(sources["CSD"], PAIR), folded(sources["SFD"], [*PAIR, "iswon"]), folded(sources["RSD"], PAIR)
    known = customer_interactions(sources | {"CSD": sales, "SFD": opps, "RSD": rentals})
    df = cl.filter_interacted(known).select("definitive_id", CUSTOMER, "customer_name")
    df = jn.enrich_left(
        df, sources["CBD"], CUSTOMER, ["active_cust_yn", "customer_class", "customer_price_group", "customer_type"]
    )
    df = jn.enrich_left(df, sources["EDD"], "definitive_id", ["staffed_beds", "net_income", "hospital_type"])
    won = cl.filter_outcome(opps, won=True).where(F.col(PRODUCT).isNotNull())
    for name, facts in (("sales_list", sales), ("salesforce_list", won), ("rental_list", rentals)):
        lists = agg.collect_products(facts, rows="n").select(CUSTOMER, F.col("items").alias(name), F.col("n_rows").alias(f"{name}_rows"))
        df = df.join(lists, CUSTOMER, "left")
    rate = agg.purchase_rate(sales, CUSTOMER, date="first_dt", last="last_dt")
    return cl.composite_key(df.join(rate, CUSTOMER, "left"))


def product_details(
    curated: DataFrame, catalog: DataFrame, sales: DataFrame, opps: DataFrame, rentals: DataFrame
) -> DataFrame:
    """One row per curated product: attributes, list sizes, average order amount and sales rate.

    The lists themselves (customers, orders, opportunities of a product) grow with the data; they stay long tables
    (``aggregates.members``) and only their sizes are kept here.  The columns of sales and opportunities are written once; each
    list is then folded to (product, element) by itself, so a task never holds the elements of several lists."""
    df = curated.select(
        *CODE_AND_NAME,
        F.col("replacement_srp_2_code").alias("new_srp_2_code"),
        F.col("updated").alias("new_srp_2_desc"),
        "product_type",
        "location",
    )
    df = jn.enrich_left(df, catalog, CODE_AND_NAME, ["srp_3_desc"])

    def sizes(facts: DataFrame, keys: list[str], name: str, element: str) -> DataFrame:
        """Rows and distinct elements of a list; a product without such rows has no row."""
        counted = facts.groupBy(*keys, element).agg(F.count(F.lit(1)).alias("n"))
        return counted.groupBy(*keys).agg(F.sum("n").alias(f"{name}_rows"), F.count(element).alias(f"{name}_items"))

    sales = materialize(sales.select(*CODE_AND_NAME, CUSTOMER, "dtl_order_num", "dtl_qty_ordered", "dtl_order_dt"))
    opps = materialize(opps.select(PRODUCT, CUSTOMER, "opp_id", "iswon"))
    days = F.datediff(F.max("dtl_order_dt"), F.min("dtl_order_dt"))
    rates = sales.groupBy(*CODE_AND_NAME).agg(
        F.avg("dtl_qty_ordered").alias("avg_order_amount"),
        (F.try_divide(F.sum("dtl_qty_ordered"), days) * 365).alias("avg_sales_per_year"),
    )
    lists = [
        (sales, CODE_AND_NAME, "sales_list", CUSTOMER), (sales, CODE_AND_NAME, "order_list", "dtl_order_num"),
        (rentals, CODE_AND_NAME, "rental_list", CUSTOMER), (opps, [PRODUCT], "salesforce_list", CUSTOMER),
        (opps.where("iswon = 'True'"), [PRODUCT], "opp_won_list", "opp_id"), (opps.where("iswon = 'False'"), [PRODUCT], "opp_lost_list", "opp_id"),
    ]
    df = df.join(rates, CODE_AND_NAME, "left")
    for facts, keys, name, element in lists:
        df = df.join(sizes(facts, keys, name, element), keys, "left")
    return df


FILL_BY_CUSTOMER = ["customer_name", "state", "county", "customer_price_group"]
FILL_BY_PRODUCT = [
    "dtl_line_type", "dtl_value_package", "dtl_qty_ordered", "dtl_unit_cost", "dtl_unit_price", "dtl_extended_price", "total_discount",
    "dtl_actual_ship_dt", "srp_1_desc", "srp_3_desc", "family",
]
FEATURES = [*PAIR, *FILL_BY_CUSTOMER, *FILL_BY_PRODUCT, "iswon"]
# Families set by hand for products whose opportunities carry none.
FAMILY_OVERRIDES = {"Brand#5": "COMMUNICATIONS", "Brand#9": "TABLES"}


def fill_quadrants(
    sales: DataFrame, opps: DataFrame, settings: Settings = DEFAULTS, fill_after: bool = True
) -> DataFrame:
    """Won sales and lost opportunities in one table, each filled with what the other lacks.

    Invoices take the columns of the nearest won opportunity of their pair, lost opportunities have
    no sales columns; what is still missing comes from the first row of the same customer or
    product that has it.  Both inputs carry ``cutoff_tag``; with ``fill_after=False`` fills are
    taken from rows up to the cutoff only.  Invoices and opportunities are written once, as each is read twice
    and lines are joined to make them; so is the stacked table, which is read by itself and by both fills."""
    sale_cols = ["cutoff_tag", "dtl_order_dt", *FILL_BY_CUSTOMER, *[c for c in FILL_BY_PRODUCT if c != "family"]]
    invoices = materialize(agg.invoices_of(sales, sale_cols))
    opp_cols = ["cutoff_tag", "close_dt", "family", "iswon", "stagename"]
    single = materialize(agg.first_per_key(opps, [*PAIR, "opp_id"], opp_cols, ["create_dt", *opp_cols]))
    won = cl.filter_outcome(single, won=True).drop("cutoff_tag")
    lost = cl.filter_outcome(single, won=False)
    top = jn.nearest_match(invoices, won, settings.tolerance_days, keep_unmatched=True).withColumn(
        "place", F.concat_ws("|", F.lit("sale"), "dtl_invoice_num", *PAIR)
    )
    bottom = lost.withColumn("place", F.concat_ws("|", F.lit("opp"), "opp_id", *PAIR))
    columns = ["place", "cutoff_tag", *FEATURES, "stagename"]
    total = materialize(st.union_missing(top, bottom).select(*columns))
    fills_from = total if fill_after else total.where(F.col("cutoff_tag") == "BEFORE")
    filled = jn.group_fill(total, {CUSTOMER: FILL_BY_CUSTOMER, PRODUCT: FILL_BY_PRODUCT}, "place", fills_from)
    labelled = cl.default_label(filled, {"iswon": "True", "stagename": "Closed Won"})
    named = cl.conditional_override(labelled, FAMILY_OVERRIDES, PRODUCT, "family")
    return cl.drop_incomplete(named.select("cutoff_tag", *FEATURES), FEATURES)


def prediction_train(
    sales: DataFrame, opps: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Training rows of the win model, from history up to the cutoff."""
    before = cl.cutoff_split(sales, "dtl_invoice_dt", settings.cutoff)[0].withColumn("cutoff_tag", F.lit("BEFORE"))
    known = cl.cutoff_split(opps, "create_dt", settings.cutoff)[0].withColumn("cutoff_tag", F.lit("BEFORE"))
    return fill_quadrants(before, known, settings).select(*FEATURES)


def prediction_test(
    sales: DataFrame, opps: DataFrame, settings: Settings = DEFAULTS, fill_after: bool = False
) -> DataFrame:
    """Rows after the cutoff, built from the whole history.

    By default missing values are filled from rows up to the cutoff, so that the test set learns
    nothing from itself; ``fill_after=True`` fills from all rows."""
    tagged_sales = cl.cutoff_tags(sales, "dtl_invoice_dt", settings.cutoff)
    tagged_opps = cl.cutoff_tags(opps, "create_dt", settings.cutoff)
    rows = fill_quadrants(tagged_sales, tagged_opps, settings, fill_after)
    return rows.where(F.col("cutoff_tag") == "AFTER").select(*FEATURES)


PROPENSITY_COLS = [
    "dtl_invoice_dt", "dtl_line_type", "dtl_qty_ordered", "dtl_unit_cost", "dtl_unit_price", "dtl_value_package",
    "total_discount", "srp_1_desc", "srp_3_desc", "county", "customer_price_group",
]


def propensity_train(
    sales: DataFrame, settings: Settings = DEFAULTS, literal: bool = False
) -> DataFrame:
    """The latest invoice of every pair up to the cutoff, with its buying rhythm and whether the
    next purchase came within ``near_sale_days``.

    With ``literal=True`` a pair that never bought again counts as buying ``max_days`` after its
    last purchase, which labels long-silent pairs as near.  Only the days of invoices are folded for all pairs, and written once.
    Few pairs have a deviation of gaps; the other columns are read for the latest invoices of these alone, and Spark looks their
    numbers up in the orders before it joins lines."""
    before, _ = cl.cutoff_split(sales, "dtl_invoice_dt", settings.cutoff)
    invoices = materialize(agg.invoice_days(sales, settings.cutoff))
    gaps = agg.gap_stats(invoices.where(F.col("dtl_invoice_dt").isNotNull())).where(F.col("gap_std").isNotNull())
    when = agg.latest_invoice(invoices)
    chosen = materialize(jn.inner_pair_join(when, gaps))
    lines = before.join(chosen.select("dtl_invoice_num"), "dtl_invoice_num", "left_semi").join(chosen.select(*INVOICE), INVOICE)
    days = F.datediff("next_dt", F.lit(settings.cutoff))
    if literal:
        days = F.coalesce(F.datediff("next_dt", "last_dt"), F.lit(settings.max_days)) - F.datediff(F.lit(settings.cutoff), "last_dt")
    rows = (
        jn.inner_pair_join(agg.invoices_of(lines, PROPENSITY_COLS), chosen.drop("dtl_invoice_num"))
        .withColumn("last_purchase_to_cutoff", F.datediff(F.lit(settings.cutoff), "last_dt").cast("bigint"))
        .withColumn("days", days)
    )
    features = [*PAIR, *PROPENSITY_COLS, "gap_mean", "gap_std", "last_purchase_to_cutoff", "outcome"]
    return cl.drop_incomplete(cl.bin_outcome(rows, "days", settings.near_sale_days).select(*features), features)


def propensity_test(sales: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Pairs bought after the cutoff, and whether the first of these purchases was near."""
    _, after = cl.cutoff_split(sales, "dtl_invoice_dt", settings.cutoff)
    first = after.groupBy(*PAIR).agg(F.min("dtl_invoice_dt").alias("first_dt"))
    limit = F.date_add(F.lit(settings.cutoff), settings.near_sale_days)
    return first.select(*PAIR, F.when(F.col("first_dt") <= limit, 1).otherwise(0).alias("outcome"))

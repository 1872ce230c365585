"""Registered queries: sources, cleaning, joins, aggregations, windows, top-k and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..operators import aggregates as agg
from ..operators import cleaning as cl
from ..operators import joins as jn
from ..operators import sets as st
from ..operators import windows as wn
from ..settings import CUSTOMER, DEFAULTS, PAIR, PRODUCT
from ..sources import stages
from ..sources import tables as t
from . import frames as fr

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def six(*cols: str) -> dict:
    return {c: F.round(c, 6) for c in cols}


RAW_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_linenumber", T.LongType()),
        T.StructField("amount_text", T.DoubleType()),
    ]
)


def _raw_text(spark: SparkSession, root: str) -> DataFrame:
    raw = t.raw_amounts(spark, root)
    return raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])


# sources and sinks


@query
def scan_csv(spark, root):
    path = stages.shared_folder(spark)
    t.raw_amounts(spark, root).write.option("header", True).csv(path)
    return stages.scan_csv(spark, path, RAW_SCHEMA)


@query
def scan_parquet(spark, root):
    return stages.scan_parquet(spark, f"{root}/customer.parquet", ["c_custkey", "c_mktsegment"])


@query
def write_stage(spark, root):
    before = fr.sales_before(spark, root).select(*PAIR, "dtl_invoice_num", "dtl_invoice_dt", "dtl_qty_ordered")
    folder = stages.shared_folder(spark)
    stages.write_stage(before, folder, "V1", "BEFORE_CUTOFF")
    return stages.read_stage(spark, folder, "V1", "BEFORE_CUTOFF")


def _cluster_ratings(spark, root):
    return fr.pair_ratings(spark, root).join(fr.customer_clusters(spark, root), CUSTOMER)


@query
def write_partitioned_matrix(spark, root):
    path = stages.write_partitioned_matrix(_cluster_ratings(spark, root), stages.shared_folder(spark))
    matrix = stages.scan_matrix(spark, path)
    return matrix.groupBy(F.col("cluster").cast("bigint").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.round(F.avg("rating"), 6).alias("mean_rating")
    )


@query
def scan_matrix(spark, root):
    path = stages.write_partitioned_matrix(_cluster_ratings(spark, root), stages.shared_folder(spark))
    one = stages.scan_matrix(spark, path, cluster=3)
    return one.select(F.col("cluster").cast("bigint").alias("cluster"), *PAIR, F.round("rating", 6).alias("rating"))


def _long_stats(stats: DataFrame) -> DataFrame:
    names = ["n_rows", "n_customers", "n_products", "n_pairs"]
    return stats.select("name", F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])))


@query
def merge_stats(spark, root):
    whole = _long_stats(agg.dataset_stats(t.sales(spark, root), "sales"))
    other = _long_stats(agg.dataset_stats(t.rentals(spark, root), "rentals"))
    newer = _long_stats(agg.dataset_stats(fr.sales_before(spark, root), "sales"))
    return stages.merge_stats(whole.unionByName(other), newer)


# cleaning


@query
def rename_columns(spark, root):
    names = {"c_custkey": "customer_num", "c_name": "customer_name", "c_mktsegment": "customer_class"}
    return cl.rename_columns(t.table(spark, root, "customer"), names).select(*names.values())


@query
def drop_columns(spark, root):
    return cl.drop_columns(t.table(spark, root, "orders"), ["o_totalprice", "o_orderdate"])


@query
def project(spark, root):
    return cl.project(t.sales(spark, root, geography=True), [*PAIR, "county", "dtl_line_type", "dtl_unit_cost"])


@query
def drop_constant_columns(spark, root):
    return cl.constant_column_probe(cl.filter_outcome(t.opportunities(spark, root), won=True))


@query
def null_tokens(spark, root):
    return cl.null_tokens(t.raw_amounts(spark, root))


@query
def clean_numeric(spark, root):
    return cl.clean_numeric(cl.null_tokens(t.raw_amounts(spark, root)), ["amount_text"])


@query
def cast_schema(spark, root):
    return cl.cast_schema(_raw_text(spark, root), RAW_SCHEMA)


@query
def fix_values(spark, root):
    text = t.table(spark, root, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("dt"))
    repairs = {"1995-01-01": "1996-01-01", "1996-02-29": "1996-03-01", "2001-07-31": "2001-08-01"}
    return cl.fix_values(text, repairs, ["dt"]).select("o_orderkey", F.col("dt").cast("date").alias("dt"))


@query
def cast_report(spark, root):
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("amount_text", T.LongType())])
    return cl.cast_report(_raw_text(spark, root), schema)


@query
def strip_code_prefix(spark, root):
    return cl.strip_code_prefix(t.curated_raw(spark, root), "code_srp_2_desc").select("srp_2_code", "code_srp_2_desc")


@query
def replacement_code(spark, root):
    raw = t.curated_raw(spark, root)
    return cl.replacement_code(raw, "replacement_srp_2_code", "srp_2_code").select("srp_2_code", "replacement_srp_2_code")


@query
def effective_product(spark, root):
    return fr.curated(spark, root).select(PRODUCT, "updated", "location", "replacement")


@query
def upper_name(spark, root):
    return cl.upper_name(t.baseline(spark, root)).select(CUSTOMER, "customer_name")


@query
def composite_key(spark, root):
    return cl.composite_key(jn.presence_full_outer(_sources(spark, root)).select(CUSTOMER, "definitive_id"))


@query
def cutoff_split_sales(spark, root):
    tagged = cl.cutoff_tags(t.sales(spark, root), "dtl_invoice_dt")
    return tagged.groupBy("cutoff_tag").agg(
        F.count(F.lit(1)).alias("n"), F.min("dtl_invoice_dt").alias("first_dt"), F.max("dtl_invoice_dt").alias("last_dt")
    )


@query
def cutoff_split_opps(spark, root):
    before, after = cl.cutoff_split(t.opportunities(spark, root), "create_dt")
    return st.union_tagged({"BEFORE": before, "AFTER": after}).select(*PAIR, "opp_id", "create_dt", "cutoff_tag")


@query
def cutoff_split_rentals(spark, root):
    before, after = cl.cutoff_split(t.rentals(spark, root), "billing_from_dt")
    return st.union_tagged({"BEFORE": before, "AFTER": after}).select(*PAIR, "billing_from_dt", "bill_days", "cutoff_tag")


def _sources(spark, root):
    return {
        "CBD": t.baseline(spark, root),
        "CWD": t.crosswalk(spark, root),
        "EDD": t.external(spark, root),
        "CSD": fr.sales_before(spark, root, geography=True),
        "SFD": fr.opps_before(spark, root),
        "RSD": cl.cutoff_split(t.rentals(spark, root), "billing_from_dt")[0],
    }


@query
def filter_interacted(spark, root):
    return cl.filter_interacted(jn.presence_full_outer(_sources(spark, root))).select(CUSTOMER, "definitive_id")


@query
def filter_outcome(spark, root):
    return cl.filter_outcome(t.opportunities(spark, root), won=False).select(*PAIR, "opp_id", "amount")


@query
def drop_incomplete(spark, root):
    return cl.drop_incomplete(t.external(spark, root), ["staffed_beds", "net_income"])


@query
def isin_filter(spark, root):
    active = fr.curated(spark, root).where(F.col("active") == "Y")
    kept = cl.isin_filter(t.sales(spark, root), active, PRODUCT)
    return kept.groupBy(PRODUCT).agg(F.count(F.lit(1)).alias("n"))


def _last_next(spark, root):
    return agg.last_next_purchase(t.sales(spark, root))


@query
def bin_outcome(spark, root):
    days = F.datediff("next_dt", F.lit(DEFAULTS.cutoff)).cast("bigint")
    binned = cl.bin_outcome(_last_next(spark, root).withColumn("days", days), "days")
    return binned.select(*PAIR, F.col("days").cast("double").alias("days"), F.col("outcome").cast("bigint").alias("outcome"))


@query
def rating_from_probability(spark, root):
    rated = cl.rating_from_probability(fr.scored_sales(spark, root), "win_prob", "predicted", "truth")
    return rated.withColumns(six("rating"))


@query
def truncate_decimals(spark, root):
    return cl.truncate_decimals(t.sales(spark, root), "dtl_unit_price", 4).select(*PAIR, "dtl_invoice_num", "dtl_unit_price")


@query
def day_diff(spark, root):
    both = t.table(spark, root, "lineitem").join(t.table(spark, root, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    late = F.col("o_orderdate") + F.expr("INTERVAL '7' HOUR")
    return both.select("l_orderkey", "l_linenumber", "l_partkey", dates.day_diff(F.col("l_shipdate"), late).alias("days"))


@query
def cutoff_to_next_purchase(spark, root):
    days = dates.days_until_next(F.col("last_dt"), F.col("next_dt"), DEFAULTS.cutoff, DEFAULTS.max_days)
    return _last_next(spark, root).select(*PAIR, days.alias("days"))


@query
def days_to_cutoff(spark, root):
    horizon = F.date_add(F.lit(DEFAULTS.cutoff), DEFAULTS.near_sale_days)
    return cl.days_to_cutoff(_last_next(spark, root), "last_dt").select(*PAIR, "days_to_cutoff", horizon.alias("horizon_dt"))


@query
def remark_labels(spark, root):
    scored = t.table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") % 5 - 3).alias("outcome"),
        (F.col("l_linenumber").cast("bigint") % 3 - 1).alias("imputed"),
    )
    return cl.remark_labels(scored)


@query
def default_label(spark, root):
    both = st.union_missing(
        fr.sales_before(spark, root).select(*PAIR, "dtl_line_type"),
        fr.opps_before(spark, root).select(*PAIR, "iswon", "stagename"),
    )
    filled = cl.default_label(both, {"iswon": "True", "stagename": "Closed Won"})
    return filled.groupBy("dtl_line_type", "iswon", "stagename").agg(F.count(F.lit(1)).alias("n"))


@query
def conditional_override(spark, root):
    overrides = {"Brand#5": "COMMUNICATIONS", "Brand#9": "TABLES"}
    return cl.conditional_override(t.opportunities(spark, root), overrides, PRODUCT, "family").select(*PAIR, "opp_id", "family")


# joins


@query
def presence_full_outer(spark, root):
    presence = jn.presence_full_outer(_sources(spark, root))
    return presence.select(CUSTOMER, "definitive_id", *[f"IN_{s}" for s in jn.SOURCES])


@query
def coalesce_name(spark, root):
    return jn.coalesce_name(jn.presence_full_outer(_sources(spark, root))).select(CUSTOMER, "definitive_id", "customer_name")


@query
def enrich_left(spark, root):
    totals = t.sales(spark, root).groupBy(CUSTOMER).agg(F.sum("dtl_qty_ordered").alias("qty"))
    return jn.enrich_left(totals, t.baseline(spark, root), CUSTOMER, ["customer_class", "customer_type", "active_cust_yn"])


@query
def enrich_left_with_gaps(spark, root):
    """A dimension with several rows per key, some of them null: opportunities as attributes of customers."""
    closed = t.opportunities(spark, root).select(
        CUSTOMER, "opp_id", F.when(F.col("iswon") == "True", F.col("family")).alias("family"), F.when(F.col("iswon") == "False", F.col("stagename")).alias("lost_stage")
    )
    return jn.enrich_left(t.baseline(spark, root).select(CUSTOMER), closed, CUSTOMER, ["family", "lost_stage"], order=["opp_id"])


@query
def first_per_key_with_gaps(spark, root):
    """First value that is not null of each column, over rows with nulls."""
    closed = t.opportunities(spark, root).select(
        PRODUCT, "opp_id", CUSTOMER, F.when(F.col("iswon") == "True", F.col("family")).alias("family"), F.when(F.col("iswon") == "False", F.col("close_dt")).alias("close_dt")
    )
    return agg.first_per_key(closed, [PRODUCT], ["family", "close_dt"], ["opp_id", CUSTOMER])


@query
def inner_pair_join(spark, root):
    return jn.inner_pair_join(
        agg.gap_stats(fr.invoice_dates(fr.sales_before(spark, root))), _last_next(spark, root)
    ).withColumns(six("gap_mean", "gap_std"))


@query
def nearest_match(spark, root):
    invoices = fr.sales_before(spark, root).select(*PAIR, "dtl_invoice_num", "dtl_order_dt").distinct()
    won = cl.filter_outcome(fr.opps_before(spark, root), won=True)
    return jn.nearest_match(invoices, won, DEFAULTS.tolerance_days).select(
        *PAIR, "dtl_invoice_num", "dtl_order_dt", "opp_id", "close_dt", "family", "delta"
    )


@query
def upsert_keep_last(spark, root):
    base = fr.sales_before(spark, root).groupBy(*PAIR).agg(F.sum("dtl_qty_ordered").alias("qty"))
    newer = fr.sales_after(spark, root).groupBy(*PAIR).agg(F.sum("dtl_qty_ordered").alias("qty"))
    return jn.upsert_keep_last(base, newer, PAIR)


@query
def group_fill(spark, root):
    both = st.union_missing(
        fr.invoices_before(spark, root, ["dtl_qty_ordered"]).select(*PAIR, F.col("dtl_invoice_num").alias("doc"), "dtl_qty_ordered"),
        fr.opps_before(spark, root).select(*PAIR, F.concat(F.lit("opp"), "opp_id").alias("doc"), "family"),
    ).withColumn("place", F.concat_ws("|", "doc", *PAIR))
    both = stages.materialize(both)
    return jn.group_fill(both, {CUSTOMER: ["dtl_qty_ordered"], PRODUCT: ["family"]}, "place").select(
        *PAIR, "doc", F.col("dtl_qty_ordered").cast("double").alias("dtl_qty_ordered"), "family"
    )


@query
def self_pairs(spark, root):
    return jn.self_pairs(t.sales(spark, root), PRODUCT)


@query
def cross_score_grid(spark, root):
    return jn.cross_score_grid(t.sales(spark, root), fr.curated(spark, root))


def _scored_pairs(spark, root):
    rated = fr.pair_ratings(spark, root)
    return rated.select(
        *PAIR,
        F.round("rating", 6).alias("rating"),
        (F.substr(PRODUCT, F.lit(7)).cast("bigint") % 2).alias("outcome"),
        (F.col(CUSTOMER).cast("bigint") % 2).alias("imputed"),
    )


@query
def drop_unowned_services(spark, root):
    recs = jn.cross_score_grid(t.sales(spark, root), fr.curated(spark, root))
    return jn.drop_unowned_services(recs, fr.sales_before(spark, root), fr.SERVICES)


@query
def purchases_with_rank(spark, root):
    ranks = wn.rank_products(_scored_pairs(spark, root))
    return jn.purchases_with_rank(fr.sales_after(spark, root).select(*PAIR, "dtl_invoice_num"), ranks)


# aggregations


INVOICE_COLS = ["dtl_invoice_dt", "dtl_qty_ordered", "dtl_unit_cost", "dtl_line_type", "dtl_value_package"]


@query
def first_per_key(spark, root):
    return agg.invoices_of(t.sales(spark, root), INVOICE_COLS)


@query
def collect_products(spark, root):
    lists = agg.collect_products(fr.sales_before(spark, root))
    return lists.select(CUSTOMER, F.array_join("items", "|").alias("items"), "n_rows", "n_items")


@query
def product_members(spark, root):
    won = cl.filter_outcome(fr.opps_before(spark, root), won=True)
    lists = {
        "sales_list": agg.member_counts(fr.sales_before(spark, root), PRODUCT, CUSTOMER),
        "order_list": agg.member_counts(fr.sales_before(spark, root), PRODUCT, "dtl_order_num"),
        "rental_list": agg.member_counts(t.rentals(spark, root), PRODUCT, CUSTOMER),
        "opp_won_list": agg.member_counts(won, PRODUCT, "opp_id"),
    }
    return st.union_tagged(lists).withColumnRenamed("cutoff_tag", "list_name")


@query
def purchase_rate(spark, root):
    return agg.purchase_rate(fr.sales_before(spark, root), CUSTOMER).withColumns(six("purchase_per_year"))


@query
def avg_order_amount(spark, root):
    return agg.avg_order_amount(fr.sales_before(spark, root), ["srp_2_code", PRODUCT]).withColumns(six("avg_order_amount"))


@query
def last_next_purchase(spark, root):
    return _last_next(spark, root)


@query
def gap_stats(spark, root):
    return agg.gap_stats(fr.invoice_dates(fr.sales_before(spark, root))).withColumns(six("gap_mean", "gap_std"))


@query
def mean_rating(spark, root):
    rated = cl.rating_from_probability(fr.scored_sales(spark, root), "win_prob", "predicted", "truth")
    return agg.mean_rating(rated).withColumns(six("rating"))


@query
def dataset_stats(spark, root):
    return agg.dataset_stats(t.sales(spark, root, geography=True), "customer sales")


@query
def merged_sketches(spark, root):
    """Statistics of the sales, added up from the sketches of both sides of the cutoff, and whether they are near the exact ones."""
    sales = t.sales(spark, root)
    runs = agg.dataset_sketches(fr.sales_before(spark, root), "customer sales").unionByName(agg.dataset_sketches(fr.sales_after(spark, root), "customer sales"))
    estimates, exact = agg.sketched_stats(agg.merge_sketches(runs)), agg.dataset_stats(sales, "customer sales")
    both = estimates.join(exact.select("name", *[F.col(c).alias(f"exact_{c}") for c in agg.SKETCHED]), "name")
    near = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= agg.SKETCH_ERROR * F.col(f"exact_{c}")).alias(f"{c}_near") for c in agg.SKETCHED]
    return both.select("name", "n_rows", *near)


def _located_ranks(spark, root):
    from ..operators.ranking import mrr_rows

    return mrr_rows(fr.pair_ratings(spark, root), fr.sales_after(spark, root), fr.curated(spark, root))


@query
def mean_by_group(spark, root):
    return agg.mean_by_group(_located_ranks(spark, root), PRODUCT, "reciprocal_rank").withColumns(six("mean_reciprocal_rank"))


@query
def rank_histogram(spark, root):
    return agg.rank_histogram(_located_ranks(spark, root))


@query
def value_histogram(spark, root):
    return agg.value_histogram(_located_ranks(spark, root), "reciprocal_rank", 10)


@query
def mode_value(spark, root):
    return agg.mode_value(t.sales(spark, root), PAIR, "dtl_qty_ordered")


def _corr_columns(spark, root):
    sales = fr.sales_before(spark, root)
    for col, code in (("srp_1_desc", "type_code"), ("dtl_value_package", "package_code")):
        sales = sales.join(agg.category_codes(sales, col).withColumnRenamed("code", code), col)
    return sales, ["dtl_qty_ordered", "dtl_unit_cost", "dtl_unit_price", "dtl_extended_price", "type_code", "package_code"]


@query
def correlation_matrix(spark, root):
    return agg.correlation_matrix(*_corr_columns(spark, root)).withColumns(six("abs_corr"))


@query
def feature_prune_by_corr(spark, root):
    return agg.feature_prune_by_corr(agg.correlation_matrix(*_corr_columns(spark, root)), 0.2)


# windows


@query
def lag_invoices(spark, root):
    return wn.lag_invoices(fr.invoice_dates(fr.sales_before(spark, root)))


@query
def day_gaps(spark, root):
    lagged = wn.day_gaps(wn.lag_invoices(fr.invoice_dates(fr.sales_before(spark, root))))
    return lagged.select(*PAIR, "dtl_invoice_num", *[F.col(f"gap_{i}").cast("double").alias(f"gap_{i}") for i in range(1, 6)])


@query
def last_row_per_pair(spark, root):
    return wn.last_row_per_pair(fr.invoices_before(spark, root))


@query
def rank_products(spark, root):
    return wn.rank_products(fr.pair_ratings(spark, root).withColumns(six("rating")))


@query
def cluster_max_score(spark, root):
    scores = (
        fr.sales_before(spark, root)
        .groupBy(CUSTOMER)
        .agg(F.sum("dtl_qty_ordered").cast("double").alias("score"))
        .join(fr.customer_clusters(spark, root), CUSTOMER)
        .withColumnRenamed(CUSTOMER, "id")
    )
    return wn.cluster_max_score(scores)


# sorts, top-k, sets


@query
def sort_purchases(spark, root):
    return st.sort_purchases(fr.invoice_dates(fr.sales_before(spark, root)))


@query
def top_k_products(spark, root):
    return st.top_k_products(_scored_pairs(spark, root), 10)


@query
def feature_ranking(spark, root):
    amounts = t.sales(spark, root).groupBy(F.col(PRODUCT).alias("feature")).agg(F.sum("dtl_qty_ordered").alias("weight"))
    return st.feature_ranking(amounts, "weight")


@query
def union_missing(spark, root):
    return st.union_missing(
        fr.sales_before(spark, root).select(*PAIR, "dtl_line_type", F.col("dtl_qty_ordered").cast("double").alias("dtl_qty_ordered")),
        fr.opps_before(spark, root).select(*PAIR, "iswon", "family"),
    )


@query
def union_tagged(spark, root):
    tagged = st.union_tagged({"BEFORE": fr.sales_before(spark, root), "AFTER": fr.sales_after(spark, root)})
    return tagged.select(*PAIR, "dtl_invoice_num", "dtl_line_num", "cutoff_tag")


@query
def distinct_pairs(spark, root):
    return st.distinct_pairs(t.sales(spark, root))


@query
def known_entities(spark, root):
    return st.known_entities(fr.sales_before(spark, root), t.baseline(spark, root), CUSTOMER)


@query
def sorted_dimension_lists(spark, root):
    return st.sorted_dimension_lists(fr.curated(spark, root), "updated")

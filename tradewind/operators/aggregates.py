"""Aggregations.  All are grouped aggregates with map-side partials, so a key holding a large share
of the rows reaches the shuffle as one row per task."""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import CUSTOMER, DEFAULTS, INVOICE, PAIR, PRODUCT
from ..sources.stages import checkpointed, materialize


def first_per_key(df: DataFrame, keys: list[str], cols: list[str], order: list[str]) -> DataFrame:
    """First non-null value of each column per key, in the total order of the ``order`` columns.

    The first of the rows without nulls stands for all columns at once; only a row with nulls is kept per column that it has,
    so where there are none a key carries one row through the shuffle and not one per column."""
    row = F.struct(*order, *[c for c in cols if c not in order])
    full = F.lit(True)
    for c in cols:
        full = full & F.col(c).isNotNull()
    firsts = df.withColumns({"_row": row, "_full": full}).groupBy(*keys).agg(
        F.min(F.when(F.col("_full"), F.col("_row"))).alias("_full"),
        *[F.min(F.when(~F.col("_full") & F.col(c).isNotNull(), F.col("_row"))).alias(f"_only_{c}") for c in cols],
    )
    return firsts.select(*keys, *[F.least("_full", f"_only_{c}")[c].alias(c) for c in cols])


def invoices_of(sales: DataFrame, cols: list[str]) -> DataFrame:
    """One row per (customer, product, invoice); the lowest line number comes first."""
    return first_per_key(sales, INVOICE, cols, ["dtl_line_num", *cols])


def collect_products(df: DataFrame, key: str = CUSTOMER, val: str = PRODUCT, rows: str | None = None) -> DataFrame:
    """Sorted distinct products per customer, with the number of rows behind them (``rows``: a column that counts them).

    Rows are counted per (customer, product) first, so the array holds at most one entry per
    product and a customer with very many rows is folded before it is gathered."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key, val).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("n"))
    return counted.groupBy(key).agg(
        F.array_sort(F.collect_list(val)).alias("items"),
        F.sum("n").alias("n_rows"),
        F.count(val).alias("n_items"),
    )


def members(df: DataFrame, key: str, element: str) -> DataFrame:
    """The list column of an entity in long form: distinct ``[key, element]``.

    Lists of customers or orders per product grow with the data, so they stay a table; null
    elements are kept to tell an empty list from a missing one."""
    return df.where(F.col(key).isNotNull()).select(key, F.col(element).alias("element")).distinct()


def member_counts(df: DataFrame, key: str, element: str) -> DataFrame:
    """``[key, n_rows, n_distinct]`` of a list column."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key, element).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(key).agg(F.sum("n").alias("n_rows"), F.count(element).alias("n_distinct"))


def purchase_rate(
    df: DataFrame, key: str | list[str], qty: str = "dtl_qty_ordered", date: str = "dtl_order_dt", last: str | None = None
) -> DataFrame:
    """Quantity per year between the first and the last order; null for a single order day.

    Folded rows carry their first day in ``date`` and their last in ``last``."""
    keys = [key] if isinstance(key, str) else key
    days = F.datediff(F.max(last or date), F.min(date))
    return df.groupBy(*keys).agg((F.try_divide(F.sum(qty), days) * 365).alias("purchase_per_year"))


def avg_order_amount(df: DataFrame, key: str | list[str], qty: str = "dtl_qty_ordered") -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.avg(qty).alias("avg_order_amount"))


def last_next_purchase(df: DataFrame, cutoff: dt.date = DEFAULTS.cutoff) -> DataFrame:
    """Last purchase up to the cutoff and first one after it, for pairs bought before the cutoff."""
    day, before = F.col("dtl_invoice_dt"), F.col("dtl_invoice_dt") <= F.lit(cutoff)
    return (
        df.groupBy(*PAIR)
        .agg(F.max(F.when(before, day)).alias("last_dt"), F.min(F.when(~before, day)).alias("next_dt"))
        .where(F.col("last_dt").isNotNull())
    )


def invoice_days(sales: DataFrame, cutoff: dt.date = DEFAULTS.cutoff) -> DataFrame:
    """Per (customer, product, invoice): the day of its first line up to the cutoff, the last day up to it and the first one after it."""
    day, before = F.col("dtl_invoice_dt"), F.col("dtl_invoice_dt") <= F.lit(cutoff)
    first = F.min(F.when(before, F.struct("dtl_line_num", day)))
    return sales.groupBy(*INVOICE).agg(
        first["dtl_invoice_dt"].alias("dtl_invoice_dt"), F.max(F.when(before, day)).alias("last_dt"), F.min(F.when(~before, day)).alias("next_dt")
    )


def latest_invoice(invoices: DataFrame) -> DataFrame:
    """``[pair, dtl_invoice_num, last_dt, next_dt]`` from ``invoice_days``: the latest invoice up to the cutoff by day and number."""
    latest = F.max(F.struct("dtl_invoice_dt", "dtl_invoice_num"))
    found = invoices.groupBy(*PAIR).agg(latest["dtl_invoice_num"].alias("dtl_invoice_num"), F.max("last_dt").alias("last_dt"), F.min("next_dt").alias("next_dt"))
    return found.where(F.col("last_dt").isNotNull())


def purchase_days(invoices: DataFrame) -> DataFrame:
    """``[pair, day, n]``: invoices per pair and calendar day, the bounded form of a pair's history."""
    return invoices.groupBy(*PAIR, F.col("dtl_invoice_dt").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def gap_stats(invoices: DataFrame) -> DataFrame:
    """Mean and sample deviation of the days between consecutive invoices of a pair.

    Invoices on the same day contribute gaps of zero, so the sums run over the pair's distinct days
    and the counts over its invoices; both stay exact whole numbers until the last step."""
    by_day = Window.partitionBy(*PAIR).orderBy("day")
    gap = F.datediff("day", F.lag("day").over(by_day)).cast("bigint")
    sums = (
        purchase_days(invoices)
        .select(*PAIR, "n", gap.alias("gap"))
        .groupBy(*PAIR)
        .agg(
            (F.sum("n") - 1).alias("k"),
            F.coalesce(F.sum("gap"), F.lit(0)).alias("s"),
            F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).alias("q"),
        )
    )
    k, s, q = F.col("k"), F.col("s"), F.col("q")
    return sums.select(
        *PAIR,
        F.try_divide(s, k).alias("gap_mean"),
        F.when(k > 1, F.sqrt(F.try_divide(k * q - s * s, k * (k - 1)))).alias("gap_std"),
    )


def mean_rating(df: DataFrame) -> DataFrame:
    return df.groupBy(*PAIR).agg(F.avg("rating").alias("rating"))


def dataset_stats(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and distinct customers, products and pairs (a null is a value of its own).

    Rows are counted per pair first; the distinct counts then run over pairs."""
    has_c, has_p = CUSTOMER in df.columns, PRODUCT in df.columns
    keys = [c for c in PAIR if c in df.columns]
    n_cols = len(df.columns)
    none = F.lit(None).cast("bigint")
    pairs = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        (F.count_distinct(F.struct(CUSTOMER)) if has_c else F.max(none)).alias("n_customers"),
        (F.count_distinct(F.struct(PRODUCT)) if has_p else F.max(none)).alias("n_products"),
        (F.count(F.lit(1)) if has_c and has_p else F.max(none)).alias("n_pairs"),
    ).select(
        F.lit(name).alias("name"),
        "n_rows",
        F.lit(n_cols).cast("bigint").alias("n_cols"),
        "n_customers",
        "n_products",
        "n_pairs",
    )


#: The sketched counts; two to the power of this many registers; the relative error that estimates keep (over four standard errors).
SKETCHED, REGISTERS, SKETCH_ERROR = ("n_customers", "n_products", "n_pairs"), 14, 0.035


def dataset_sketches(df: DataFrame, name: str) -> DataFrame:
    """``[name, n_rows, n_customers, n_products, n_pairs]``: the rows of a run, and sketches of what ``dataset_stats`` counts.

    A sketch has a fixed size, so it is kept in a table of statistics and added to those of other runs without a re-read."""
    keys = {"n_customers": F.xxhash64(CUSTOMER), "n_products": F.xxhash64(PRODUCT), "n_pairs": F.xxhash64(*PAIR)}
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.hll_sketch_agg(k, F.lit(REGISTERS)).alias(c) for c, k in keys.items()]).select(F.lit(name).alias("name"), "n_rows", *SKETCHED)


def merge_sketches(runs: DataFrame) -> DataFrame:
    """One row per name, as if all its runs had been one."""
    return runs.groupBy("name").agg(F.sum("n_rows").alias("n_rows"), *[F.hll_union_agg(c).alias(c) for c in SKETCHED])


def sketched_stats(sketches: DataFrame) -> DataFrame:
    """Sketches as estimated counts."""
    return sketches.select("name", "n_rows", *[F.hll_sketch_estimate(c).alias(c) for c in SKETCHED])


def mean_by_group(df: DataFrame, by: str, val: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(val).alias(f"mean_{val}"))


def rank_histogram(df: DataFrame, by: str = "location") -> DataFrame:
    return df.groupBy(by, "rank").agg(F.count(F.lit(1)).alias("n"))


def value_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value.

    Equal values are counted together first, in a table that bounds and bins are both taken from."""
    counts = materialize(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")))
    edges = counts.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("edge")).scalar()
    lo, hi = edges.getField("lo"), edges.getField("hi")
    place = F.floor(F.try_divide((F.col(col) - lo) * bins, hi - lo))
    return (
        counts.select(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("bigint").alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )


def mode_value(df: DataFrame, keys: list[str], val: str) -> DataFrame:
    """Most frequent value per key, the smallest one on ties, from a histogram."""
    counts = df.where(F.col(val).isNotNull()).groupBy(*keys, val).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(val).alias("mode"))).alias("best")).select(
        *keys, "best.mode"
    )


def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``place``, the row's number from 0 in the given order over the whole table.

    Rows are range-partitioned and fixed with a checkpoint; each partition numbers its own rows and
    adds the sizes of the partitions before it, so no task sorts all rows.  The order should tell
    rows apart, so that equal values can be split over partitions."""
    fixed = checkpointed(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    sizes = fixed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = fixed.withColumn("within", within).join(starts, "part")
    return placed.select(*df.columns, (F.col("start") + F.col("within") - 1).cast("bigint").alias("place"))


def category_codes(df: DataFrame, col: str) -> DataFrame:
    """``[col, code]``: distinct values numbered from 0 in sorted order."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    return numbered(values, [F.col(col)]).withColumnRenamed("place", "code")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """``[a, b, abs_corr]`` for all pairs of the given numeric columns, in one aggregate."""
    named = list(combinations(cols, 2))
    row = df.agg(*[F.abs(F.corr(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(named)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("abs_corr"))
        for i, (a, b) in enumerate(named)
    ]
    return row.select(F.inline(F.array(*cells)))


def feature_prune_by_corr(corr: DataFrame, threshold: float) -> DataFrame:
    """``[column_name]`` to drop: the later column of every pair above the threshold whose earlier
    column is itself kept.  Walks column pairs, of which there are as many as the schema allows."""
    spark = corr.sparkSession
    high = sorted((r.a, r.b) for r in corr.where(F.col("abs_corr") > threshold).collect())
    dropped: list[str] = []
    for a, b in high:
        if a not in dropped and b not in dropped:
            dropped.append(b)
    return spark.createDataFrame([(c,) for c in sorted(dropped)], "column_name string")



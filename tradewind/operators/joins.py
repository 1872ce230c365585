"""Joins.

Two habits keep them safe when one key holds a large share of the rows:

* fact rows are reduced to (pair, calendar day) before any window or many-to-many match, so the
  size of a group is bounded by the number of days in the data, not by the number of rows;
* the other side of every fact join is unique on its key, so a hot key is split by Spark's
  skew-join handling and can not multiply rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import days_between
from ..settings import CUSTOMER, PAIR, PRODUCT
from ..sources.stages import materialize
from .aggregates import first_per_key

SOURCES = ["CBD", "CSD", "CWD", "EDD", "RSD", "SFD"]
NAME_ORDER = ["CBD", "EDD", "CSD", "CWD", "RSD"]


def presence_full_outer(sources: dict[str, DataFrame]) -> DataFrame:
    """Which source knows which customer, with the best name each one offers.

    Full outer joins of five customer tables are one union and one grouped aggregate.  Each source is first folded to its
    distinct customers, ids and names: equal rows meet in a hash table, whereas the smallest name, a text, is found by
    sorting, which would hold all rows of a task.  Only the table
    keyed by ``definitive_id`` is joined; a customer without that id joins under its own number, which
    matches nothing, so that missing ids do not meet in one task."""
    keyed_by_customer = [s for s in SOURCES if s != "EDD"]

    def rows(name: str) -> DataFrame:
        df = sources[name]
        has = set(df.columns)
        return df.where(F.col(CUSTOMER).isNotNull()).select(
            CUSTOMER,
            (F.col("definitive_id") if "definitive_id" in has else F.lit(None).cast("string")).alias("definitive_id"),
            (F.col("customer_name") if "customer_name" in has else F.lit(None).cast("string")).alias("customer_name"),
            F.lit(name).alias("source"),
        ).distinct()

    def name_from(source: str) -> Column:
        named = F.nullif(F.col("customer_name"), F.lit(""))
        return F.min(F.when(F.col("source") == source, named)).alias(f"name_{source}")

    known = (
        reduce(DataFrame.unionByName, [rows(s) for s in keyed_by_customer])
        .groupBy(CUSTOMER)
        .agg(
            F.min("definitive_id").alias("definitive_id"),
            *[F.max(F.col("source") == s).alias(f"IN_{s}") for s in keyed_by_customer],
            *[name_from(s) for s in NAME_ORDER if s != "EDD"],
        )
    )
    hospitals = (
        sources["EDD"]
        .where(F.col("definitive_id").isNotNull())
        .groupBy("definitive_id")
        .agg(F.min(F.nullif(F.col("customer_name"), F.lit(""))).alias("name_EDD"))
        .withColumn("IN_EDD", F.lit(True))
    )
    no_id = F.col("definitive_id").isNull()
    known = known.withColumn("unlinked", F.when(no_id, F.col(CUSTOMER)).otherwise("")).withColumn(
        "definitive_id", F.coalesce("definitive_id", F.lit(""))
    )
    both = known.join(hospitals.withColumn("unlinked", F.lit("")), ["definitive_id", "unlinked"], "full")
    return both.select(
        F.coalesce(CUSTOMER, F.lit("")).alias(CUSTOMER),
        "definitive_id",
        *[F.coalesce(f"IN_{s}", F.lit(False)).alias(f"IN_{s}") for s in SOURCES],
        *[f"name_{s}" for s in NAME_ORDER],
    )


def coalesce_name(presence: DataFrame) -> DataFrame:
    """One upper-case name per customer, from the most trusted source that has one."""
    return presence.withColumn(
        "customer_name", F.upper(F.coalesce(*[F.col(f"name_{s}") for s in NAME_ORDER]))
    ).drop(*[f"name_{s}" for s in NAME_ORDER])


def enrich_left(df: DataFrame, dim: DataFrame, key: str | list[str], cols: list[str], order: list[str] | None = None) -> DataFrame:
    """Left join of attributes; the dimension is reduced to one row per key first.

    Each column takes its own first value that is not null, in the order of the ``order`` columns (then of
    the attributes), so a row with a blank does not hide another row's value; without an order, the smallest."""
    keys = [key] if isinstance(key, str) else key
    if order:
        picked = first_per_key(dim, keys, cols, [*order, *[c for c in cols if c not in order]])
    else:
        picked = dim.groupBy(*keys).agg(*[F.min(c).alias(c) for c in cols])
    return df.join(picked, keys, "left")


def inner_pair_join(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, PAIR)


def nearest_match(
    invoices: DataFrame, opps: DataFrame, tol_days: int = 90, keep_unmatched: bool = False
) -> DataFrame:
    """Each invoice with the closest-in-time opportunity of its pair, if within ``tol_days``.

    ``keep_unmatched`` also returns the other invoices, with null opportunity columns.

    Ties go to the smaller ``opp_id``.  Invoices and opportunities are reduced to one row per pair
    and day; on a day only the smallest ``opp_id`` can win.  Two running windows then carry the
    latest earlier and the earliest later opportunity to every invoice day, instead of joining all
    opportunities of a pair with all its invoices."""
    extra = [c for c in opps.columns if c not in PAIR]
    payload = F.struct("opp_id", *[c for c in extra if c != "opp_id"])
    none = F.lit(None)
    invoice_days = invoices.select(*PAIR, F.col("dtl_order_dt").alias("day")).distinct()
    opp_days = (
        opps.where(F.col("close_dt").isNotNull())
        .groupBy(*PAIR, F.col("close_dt").alias("day"))
        .agg(F.min(payload).alias("opp"))
    )
    opp_type = opp_days.schema["opp"].dataType
    timeline = invoice_days.select("*", none.cast(opp_type).alias("opp")).unionByName(opp_days)
    upto = Window.partitionBy(*PAIR).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    around = timeline.select(
        *PAIR,
        "day",
        "opp",
        F.last("opp", ignorenulls=True).over(upto.orderBy(F.col("day").asc())).alias("before"),
        F.last("opp", ignorenulls=True).over(upto.orderBy(F.col("day").desc())).alias("after"),
    ).where(F.col("opp").isNull())

    def candidate(side: str) -> Column:
        delta = F.abs(days_between(F.col(f"{side}.close_dt"), F.col("day")))
        return F.when(delta <= tol_days, F.struct(delta.alias("delta"), F.col(side).alias("opp")))

    matched = around.select(
        *PAIR, "day", F.array_min(F.array(candidate("before"), candidate("after"))).alias("best")
    ).where(F.col("best").isNotNull())
    own = [c for c in invoices.columns if c not in PAIR]
    return (
        invoices.withColumn("day", F.col("dtl_order_dt"))
        .join(matched, [*PAIR, "day"], "left" if keep_unmatched else "inner")
        .select(
            *PAIR,
            *own,
            *[F.col(f"best.opp.{c}").alias(c) for c in extra if c not in own],
            F.col("best.delta").alias("delta"),
        )
    )


def upsert_keep_last(base: DataFrame, newer: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``base`` replaced by the row of ``newer`` with the same key; one row per key."""
    both = base.select("*", F.lit(0).alias("priority")).unionByName(
        newer.select("*", F.lit(1).alias("priority")), allowMissingColumns=True
    )
    rest = [c for c in both.columns if c not in keys and c != "priority"]
    return (
        both.groupBy(*keys)
        .agg(F.max(F.struct("priority", *rest)).alias("row"))
        .select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])
    )


def group_fill(df: DataFrame, fills: dict[str, list[str]], order: str, stats_from: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the first non-null value of the same key, in the total order ``order``.

    One aggregate and one join per key, whatever the number of columns.  The first values are written before the join, so that
    Spark knows their size and broadcasts a short list of keys; rows that lack nothing are not joined at all."""
    source = df if stats_from is None else stats_from
    for key, cols in fills.items():
        firsts = source.groupBy(key).agg(
            *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"first_{c}") for c in cols]
        )
        lacks = reduce(Column.__or__, [F.col(c).isNull() for c in cols])
        filled = df.where(lacks).join(materialize(firsts), key, "left").withColumns({c: F.coalesce(F.col(c), F.col(f"first_{c}")) for c in cols})
        df = df.where(~lacks).unionByName(filled.select(*df.columns))
    return df


#: Values in a block of ``self_pairs`` and ``cross_score_grid``.
BLOCK = 1000


def _blocks(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """``[col, block]`` of the distinct values, in hash blocks of about ``BLOCK``, and the number of blocks."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    n = F.ceil(F.greatest(values.agg(F.count(F.lit(1)).alias("n")).scalar() / BLOCK, F.lit(1.0))).cast("int")
    return values.withColumn("block", F.pmod(F.xxhash64(col), n).cast("int")), n


def self_pairs(entities: DataFrame, key: str) -> DataFrame:
    """All unordered pairs of a dimension, as ``[id_i, id_j]`` with ``id_i < id_j``.

    The pairs are the result; they are made block against block, so the work spreads over tasks of bounded
    size and no list of ids is gathered."""
    values, n = _blocks(entities, key)
    rows = values.select(F.col(key).alias("id_i"), F.col("block").alias("at"), F.explode(F.sequence(F.lit(0), n - 1)).alias("with"))
    others = values.select(F.col(key).alias("id_j"), F.col("block").alias("with"), F.explode(F.sequence(F.lit(0), n - 1)).alias("at"))
    return rows.join(others, ["at", "with"]).where("id_i < id_j").select("id_i", "id_j")


def cross_score_grid(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every listed customer with every listed product: the grid itself is what is asked for.

    Products come in blocks; a customer meets each block in a join."""
    shelf, n = _blocks(products, PRODUCT)
    wanted = customers.select(CUSTOMER).where(F.col(CUSTOMER).isNotNull()).distinct()
    return wanted.select(CUSTOMER, F.explode(F.sequence(F.lit(0), n - 1)).alias("block")).join(shelf, "block").select(CUSTOMER, PRODUCT)


def drop_unowned_services(recs: DataFrame, owned: DataFrame, service_map: dict[str, list[str]]) -> DataFrame:
    """Remove services that belong to a product the customer does not own.

    ``service_map`` (product to services) is configuration.  What a customer owns of the mapped
    products is gathered per customer, at most one entry per mapped product."""
    mapped = sorted(service_map)
    has = (
        owned.where(F.col(PRODUCT).isin(mapped))
        .groupBy(CUSTOMER)
        .agg(F.collect_set(PRODUCT).alias("owned_mapped"))
    )
    held = F.coalesce(F.col("owned_mapped"), F.array().cast("array<string>"))
    lost = F.lit(False)
    for product, services in service_map.items():
        lost = lost | (~F.array_contains(held, product) & F.col(PRODUCT).isin(services))
    return recs.join(has, CUSTOMER, "left").where(~lost).drop("owned_mapped")


def purchases_with_rank(purchases: DataFrame, ranks: DataFrame) -> DataFrame:
    """Purchases of ranked pairs, with the rank; ``ranks`` is unique per pair."""
    return purchases.join(ranks.select(*PAIR, "rank"), PAIR)

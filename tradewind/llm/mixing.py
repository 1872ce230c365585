"""Mixing sources to target weights: tempered shares, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power of an exponent, normalised. The exponent is the largest
in [0, 1] with which the weights' entropy reaches ``evenness`` of its maximum, unless a source would then be
repeated more than ``repeats`` times; then it is the least that keeps that limit. Both are found by bisection
inside one expression over the sources' totals.

A source's budget (weight times all tokens to give out) is realised in blocks. Each block is a permutation of
all the source's documents, by a hash of block number, id and text; every block but the last is whole, and the last
ends with the document that reaches the budget. Where a block ends comes from token sums by hash prefix, then
from the rows of one prefix, so a source with a third of all rows is never gathered. Only DataFrame functions
are used. One value per source is gathered in one row: sources are a dimension.

Tokens are words. Rows: a null source is a source of its own. Texts that are null or have no words use no budget;
a source that has only such is given out once. Rows without an id, and rows that share one, have places of their own by
their texts; rows that agree in id, source and text are alike, and stand or fall together. A very long text is a row with many tokens,
and may end a block. An empty table gives an empty table; columns with other names are carried and not read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.sources.stages import materialize

EVENNESS, REPEATS, BUDGET, SEED, STEPS = 0.97, 4.0, 1.0, 7, 50
#: Documents that share a hash prefix on average, at most.
PER_PREFIX = 10_000


def _bisect(test, wanted_low: bool) -> Column:
    """End of [0, 1] after ``STEPS`` halvings; ``test(x)`` tells whether the answer is at or above x."""
    def step(state: Column, _: Column) -> Column:
        mid = (state["low"] + state["high"]) / 2
        up = test(mid)
        return F.struct(F.when(up, mid).otherwise(state["low"]).alias("low"), F.when(up, state["high"]).otherwise(mid).alias("high"))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["low"] if wanted_low else s["high"])


def _total(shares: Column, value) -> Column:
    return F.aggregate(shares, F.lit(0.0), lambda s, p: s + value(p))


def source_weights(sizes: DataFrame, evenness: float = EVENNESS, repeats: float = REPEATS, budget: float = BUDGET) -> DataFrame:
    """[s, tokens, weight, target] for each source of ``sizes`` [s, tokens]; target is its budget in tokens."""
    total = sizes.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"),
        F.array_sort(F.collect_list(F.when(F.col("tokens") > 0, F.col("tokens").cast("double")))).alias("list"),
    ).withColumn("shares", F.transform("list", lambda t: t / F.col("total")))
    shares, n = F.col("shares"), F.size("shares")

    def entropy(x: Column) -> Column:
        norm = _total(shares, lambda p: F.pow(p, x))
        return F.ln(norm) - x * _total(shares, lambda p: F.pow(p, x) * F.ln(p)) / norm

    def repeated(x: Column) -> Column:
        least = F.array_min(shares)
        return F.pow(least, x) / _total(shares, lambda p: F.pow(p, x)) * budget / least

    even = F.when(entropy(F.lit(1.0)) >= evenness * F.ln(n.cast("double")), 1.0).otherwise(_bisect(lambda x: entropy(x) >= evenness * F.ln(n.cast("double")), True))
    limit = F.when(repeated(F.lit(0.0)) <= repeats, 0.0).otherwise(_bisect(lambda x: repeated(x) > repeats, False))
    total = total.withColumn("x", F.greatest(even, limit)).withColumn("norm", _total(shares, lambda p: F.pow(p, F.col("x"))))
    whole = total.select(F.struct("total", "x", "norm").alias("whole")).scalar()
    share = F.pow(F.col("tokens") / whole["total"], whole["x"]) / whole["norm"]
    weight = F.when(F.col("tokens") > 0, share).otherwise(0.0)
    return sizes.select("s", "tokens", weight.alias("weight"), F.ceil(weight * whole["total"] * budget).alias("target"))


def source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def order_key(seed: int, block: Column) -> Column:
    """The place of a document in a block's permutation: by its id and its text, as rows may share an id or have none."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "digest"))


def text_digest() -> Column:
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def block_plan(counted: DataFrame, evenness: float = EVENNESS, repeats: float = REPEATS, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """[s, weight, target, whole, last_key]: whole blocks of each source, and the last key of the block after them
    (null: none of it). ``counted`` has [doc_id, s, tokens, digest]."""
    sizes = counted.groupBy("s").agg(F.sum("tokens").alias("tokens"))
    weights = source_weights(sizes, evenness, repeats, budget)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens"))).otherwise(1).alias("whole")
    plan = materialize(weights.select("*", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("tokens")))
    digits = max(1, math.ceil(math.log(max(counted.count() / PER_PREFIX, 1), 16)))
    keyed = counted.join(plan.where("rest > 0").select("s", "whole", "rest"), "s").select("s", "rest", "tokens", order_key(seed, F.col("whole")).alias("key"))
    keyed = keyed.withColumn("prefix", F.substring("key", 1, digits))
    sums = keyed.groupBy("s", "rest", "prefix").agg(F.sum("tokens").alias("part"))
    up_to = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    crossed = sums.withColumn("sum", F.sum("part").over(up_to)).where("sum >= rest and sum - part < rest")
    inner = keyed.join(crossed.select("s", "prefix", (F.col("sum") - F.col("part")).alias("before")), ["s", "prefix"])
    along = Window.partitionBy("s").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    ends = inner.withColumn("sum", F.col("before") + F.sum("tokens").over(along)).where("sum >= rest").groupBy("s").agg(F.min("key").alias("last_key"))
    # Written, so that its size is known to the joins with documents: a row per source.
    return materialize(plan.join(ends, "s", "left").select("s", "weight", "target", "whole", "last_key"))


def _given_out(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``rows`` (with a column s) once for each block they are in, with block and key."""
    blocks = F.explode(F.sequence(F.lit(0), F.col("whole").cast("int")))
    each = rows.join(plan, "s").withColumn("block", blocks).withColumn("key", order_key(seed, F.col("block")))
    return each.where("block < whole or key <= last_key")


def counted_documents(docs: DataFrame) -> DataFrame:
    """[doc_id, source, s, tokens, digest] of every row, written once."""
    return materialize(docs.select("doc_id", "source", source_key().alias("s"), word_count().alias("tokens"), text_digest().alias("digest")))


def mix(docs: DataFrame, evenness: float = EVENNESS, repeats: float = REPEATS, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """[doc_id, source, n_tokens, weight, target, block, key] for every time a document is given out.

    Source by source, rows by block and key are the training order; a source's rows hold its budget."""
    counted = counted_documents(docs)
    plan = block_plan(counted, evenness, repeats, budget, seed)
    return _given_out(counted, plan, seed).select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), F.round("weight", 9).alias("weight"), F.col("target").cast("long").alias("target"), F.col("block").cast("long").alias("block"), "key"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as it is given out; texts are not shuffled."""
    plan = block_plan(counted_documents(docs), **options)
    names = ["_mix_" + str(i) for i in range(len(docs.columns))]
    held = docs.select(source_key().alias("s"), "doc_id", text_digest().alias("digest"), *(F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)))
    out = _given_out(held, plan, options.get("seed", SEED))
    return out.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))

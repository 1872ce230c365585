"""Joins, aggregates and windows on hand-made rows, with one pair holding most of them."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tradewind.functions.cleaning import without_code
from tradewind.operators import aggregates as agg
from tradewind.operators import joins as jn
from tradewind.operators import ranking as rk
from tradewind.operators import sets as st
from tradewind.operators import windows as wn

DAY0 = dt.date(1999, 1, 1)
INVOICES = "customer_num string, srp_2_desc string, dtl_invoice_num string, dtl_invoice_dt date"


def day(n):
    return DAY0 + dt.timedelta(days=n)


def invoices(spark, seed=3):
    """About 400 invoices, half of them of one pair, many on the same day."""
    draw, rows = random.Random(seed), []
    for i in range(400):
        pair = ("hot", "P1") if i % 2 else (f"c{draw.randint(1, 9)}", f"P{draw.randint(1, 4)}")
        rows.append((*pair, f"{i:04d}", day(draw.randint(0, 60))))
    return rows, spark.createDataFrame(rows, INVOICES)


def by_pair(rows):
    groups = {}
    for c, p, number, d in rows:
        groups.setdefault((c, p), []).append((d, number))
    return {k: sorted(v) for k, v in groups.items()}


def test_lags_and_gaps_equal_a_row_by_row_walk(spark):
    rows, df = invoices(spark)
    want = {}
    for pair, line in by_pair(rows).items():
        for at, (_, number) in enumerate(line):
            want[(*pair, number)] = [line[at - i][0] if at >= i else None for i in range(1, 6)]
    lagged = wn.lag_invoices(df)
    got = {(r[0], r[1], r[2]): [r[f"inv_{i}"] for i in range(1, 6)] for r in lagged.collect()}
    assert got == want
    first = wn.day_gaps(lagged).where("inv_1 IS NOT NULL").first()
    assert first.gap_1 == (first.dtl_invoice_dt - first.inv_1).days


def test_gap_stats(spark):
    rows, df = invoices(spark)
    rows = rows + [("one", "P", "1", day(0)), ("two", "P", "1", day(0)), ("two", "P", "2", day(4))]
    got = {(r[0], r[1]): (r.gap_mean, r.gap_std) for r in agg.gap_stats(spark.createDataFrame(rows, INVOICES)).collect()}
    for pair, line in by_pair(rows).items():
        gaps = [(b[0] - a[0]).days for a, b in zip(line, line[1:])]
        mean, std = got[pair]
        assert mean == (pytest.approx(statistics.mean(gaps)) if gaps else None)
        assert std == (pytest.approx(statistics.stdev(gaps)) if len(gaps) > 1 else None)


def test_nearest_match_equals_comparing_all(spark):
    rows, df = invoices(spark)
    draw, opps = random.Random(5), []
    for i in range(150):
        pair = ("hot", "P1") if i % 2 else (f"c{draw.randint(1, 9)}", f"P{draw.randint(1, 4)}")
        opps.append((*pair, f"o{i:03d}", day(draw.randint(-150, 200)), f"f{i}"))
    opp_df = spark.createDataFrame(opps, "customer_num string, srp_2_desc string, opp_id string, close_dt date, family string")
    want = {}
    for c, p, number, d in rows:
        near = [(abs((o[3] - d).days), o[2], o[4]) for o in opps if o[:2] == (c, p)]
        if near and min(near)[0] <= 5:
            want[(c, p, number)] = min(near)
    inv = df.withColumnRenamed("dtl_invoice_dt", "dtl_order_dt")
    got = {(r[0], r[1], r.dtl_invoice_num): (r.delta, r.opp_id, r.family) for r in jn.nearest_match(inv, opp_df, 5).collect()}
    assert got == want
    kept = jn.nearest_match(inv, opp_df, 5, keep_unmatched=True)
    assert kept.count() == len(rows) and kept.where("opp_id IS NOT NULL").count() == len(want)


def test_tolerance_and_closest_of_two(spark):
    inv = spark.createDataFrame([("a", "p", "1", day(0)), ("b", "p", "2", day(0))], "customer_num string, srp_2_desc string, dtl_invoice_num string, dtl_order_dt date")
    opps = spark.createDataFrame(
        [("a", "p", "x", day(10)), ("a", "p", "y", day(-5)), ("b", "p", "z", day(91))],
        "customer_num string, srp_2_desc string, opp_id string, close_dt date",
    )
    assert [(r.customer_num, r.opp_id) for r in jn.nearest_match(inv, opps).collect()] == [("a", "y")]


def test_first_per_key_skips_nulls(spark):
    df = spark.createDataFrame([("k", 1, None, "x"), ("k", 2, 5, "y")], "k string, n int, a int, b string")
    assert agg.first_per_key(df, ["k"], ["a", "b"], ["n"]).first()[1:] == (5, "x")


def test_enrich_left_takes_each_columns_first_value(spark):
    ids = spark.createDataFrame([("k",), ("m",)], "k string")
    dim = spark.createDataFrame([("k", 1, None, "y"), ("k", 2, "B", "x"), ("k", 3, "A", None)], "k string, n int, a string, b string")
    assert {r.k: (r.a, r.b) for r in jn.enrich_left(ids, dim, "k", ["a", "b"]).collect()} == {"k": ("A", "x"), "m": (None, None)}
    assert jn.enrich_left(ids, dim, "k", ["a", "b"], order=["n"]).where("k = 'k'").first()[1:] == ("B", "y")


def test_group_fill_takes_the_first_value_of_the_key(spark):
    df = spark.createDataFrame([("a", "1", None), ("a", "2", 7), ("a", "3", 9), ("b", "4", None)], "k string, place string, v int")
    assert {r.place: r.v for r in jn.group_fill(df, {"k": ["v"]}, "place").collect()} == {"1": 7, "2": 7, "3": 9, "4": None}


def test_upsert_prefers_the_newer_row(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    newer = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in jn.upsert_keep_last(base, newer, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_ranks_share_ties_and_leave_nulls_out(spark):
    df = spark.createDataFrame([("c", p, r) for p, r in zip("wxyz", [3.0, 2.0, 2.0, None])], "customer_num string, srp_2_desc string, rating double")
    assert {r.srp_2_desc: r["rank"] for r in wn.rank_products(df).collect()} == {"w": 1.0, "x": 2.5, "y": 2.5}


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("k", v) for v in (2, 1, 2, 1, None)], "k string, v int")
    assert agg.mode_value(df, ["k"], "v").first().mode == 1


def test_rate_of_a_single_day_is_null(spark):
    df = spark.createDataFrame([("c", 5, day(0)), ("c", 6, day(0))], "customer_num string, dtl_qty_ordered long, dtl_order_dt date")
    assert agg.purchase_rate(df, "customer_num").first().purchase_per_year is None


def test_top_k_is_a_prefix_and_zero_means_all(spark):
    draw = random.Random(1)
    rows = [(f"c{i % 3}", f"p{i:02d}", float(draw.randint(0, 4)), draw.randint(0, 1), draw.randint(0, 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_num string, srp_2_desc string, rating double, outcome int, imputed int")
    full = {tuple(r) for r in st.top_k_products(df, 0).collect()}
    assert len(full) == 60 and {tuple(r) for r in st.top_k_products(df, 4).collect()} == {r for r in full if r[-1] <= 4}


def test_services_of_products_not_owned_are_dropped(spark):
    recs = spark.createDataFrame([("a", s) for s in ("S", "T", "X")] + [("b", "S")], "customer_num string, srp_2_desc string")
    owned = spark.createDataFrame([("a", "P"), ("a", "Q")], "customer_num string, srp_2_desc string")
    left = jn.drop_unowned_services(recs, owned, {"P": ["S"], "Q": ["S"], "R": ["T"]})
    assert sorted(tuple(r) for r in left.collect()) == [("a", "S"), ("a", "X")]


def test_pairs_and_grids_come_in_blocks(spark, monkeypatch):
    df = spark.range(30).select(F.col("id").cast("string").alias("srp_2_desc"), F.concat(F.lit("c"), "id").alias("customer_num"))
    for size in (1000, 7):
        monkeypatch.setattr(jn, "BLOCK", size)
        pairs = jn.self_pairs(df, "srp_2_desc")
        assert pairs.count() == pairs.distinct().count() == 435
        grid = jn.cross_score_grid(df, df)
        assert grid.count() == grid.distinct().count() == 900
    assert jn.self_pairs(df.limit(0), "srp_2_desc").count() == jn.cross_score_grid(df, df.limit(0)).count() == 0


def test_a_hot_pair_and_day(spark):
    """A third of all invoices on one day of one pair."""
    rows = [("c", "p", f"{i:05d}", day(3)) for i in range(3000)] + [("c", "p", f"{i:05d}", day(i % 40)) for i in range(5000, 9000)]
    df = spark.createDataFrame(rows, "customer_num string, srp_2_desc string, dtl_invoice_num string, dtl_invoice_dt date")
    got = {r.dtl_invoice_num: tuple(r[f"inv_{k}"] for k in range(1, 6)) for r in wn.lag_invoices(df).collect()}
    ordered = sorted(rows, key=lambda r: (r[3], r[2]))
    assert len(got) == 7000
    for at in (0, 1, 4, 90, 400, 2500, 6999):
        assert got[ordered[at][2]] == tuple(ordered[at - k][3] if at >= k else None for k in range(1, 6))


def test_a_long_name_is_kept_whole(spark):
    name = "123 " + "x" * 1_500_000
    assert len(spark.createDataFrame([(name,)], "n string").select(without_code(F.col("n")).alias("n")).first().n) == 1_500_000


def test_category_codes_are_dense_and_sorted(spark):
    df = spark.range(1000).select(F.concat(F.lit("v"), (F.col("id") * 7919 % 500).cast("string")).alias("c"))
    codes = sorted((r.c, r.code) for r in agg.category_codes(df, "c").collect())
    assert [code for _, code in codes] == list(range(500))


def test_precision_and_recall(spark):
    rows = [("c", f"p{i}", rank) for i, rank in enumerate([1.0, 10.0, 10.5, 30.0])] + [("c", "p0", 1.0)]
    df = spark.createDataFrame(rows, "customer_num string, srp_2_desc string, rank double")
    assert tuple(rk.precision_recall_at_k(df, 10).first()) == (pytest.approx(0.2), pytest.approx(0.5))


def test_results_do_not_depend_on_partitioning(spark, small_root):
    from tradewind.plans import registry

    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = {q: sorted(map(str, registry.queries()[q](spark, small_root).collect())) for q in ("nearest_match", "undersample", "recommend")}
        seen.append(got)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_presence_folds_each_source_without_sorting_its_rows(spark):
    """Rows are folded by their columns before the smallest name is looked for, a text that Spark finds by sorting."""
    named = spark.range(1000).select((F.col("id") % 3).cast("string").alias("customer_num"), F.concat(F.lit("n"), (F.col("id") % 2).cast("string")).alias("customer_name"))
    other = named.select("customer_num")
    hospitals = spark.createDataFrame([("9", "h")], "definitive_id string, customer_name string")
    links = other.select("customer_num", F.col("customer_num").alias("definitive_id")).distinct()
    presence = jn.presence_full_outer({"CBD": named, "CSD": named, "CWD": links, "EDD": hospitals, "RSD": other, "SFD": other})
    assert sorted((r.customer_num, r.name_CSD, r.IN_SFD) for r in presence.collect()) == [("", None, False), ("0", "n0", True), ("1", "n0", True), ("2", "n0", True)]
    plan = presence._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union") :]
    assert union.count("Aggregate [") >= 5


def test_first_per_key_carries_one_row_where_nothing_is_missing(spark):
    """Each column's first value that is not null, nulls in the order included; and the plan holds one row per key, not one per column."""
    draw = random.Random(5)
    some = lambda v: None if draw.random() < 0.4 else v
    rows = [(f"k{draw.randint(0, 5)}", some(draw.randint(0, 3)), some(f"a{draw.randint(0, 9)}"), some(draw.random())) for _ in range(300)]
    rows += [("none", 1, None, None), ("late", 1, None, 0.5), ("late", 2, "x", None)]
    df = spark.createDataFrame(rows, "k string, n int, a string, b double")
    low = lambda v: (v is not None, v if v is not None else 0)
    want = {}
    for key in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == key], key=lambda r: (low(r[1]), (r[2] is not None, r[2] or ""), low(r[3])))
        want[key] = tuple(next((r[i] for r in own if r[i] is not None), None) for i in (2, 3))
    firsts = agg.first_per_key(df, ["k"], ["a", "b"], ["n", "a", "b"])
    assert {r.k: (r.a, r.b) for r in firsts.collect()} == want
    assert "min_by" not in firsts._jdf.queryExecution().optimizedPlan().toString()


def test_group_fill_joins_only_rows_that_lack_something(spark):
    rows = [("1", "a", "p", "x", None), ("2", "a", "p", None, 5), ("3", "a", "q", None, None), ("4", "b", "q", "z", 7), ("5", "c", None, None, 1), ("6", None, "p", None, None)]
    df = spark.createDataFrame(rows, "place string, c string, p string, u string, v int")
    filled = jn.group_fill(df, {"c": ["u"], "p": ["v"]}, "place")
    assert {r.place: (r.u, r.v) for r in filled.collect()} == {"1": ("x", 5), "2": ("x", 5), "3": ("x", 7), "4": ("z", 7), "5": (None, 1), "6": (None, 5)}
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Aggregate" not in plan

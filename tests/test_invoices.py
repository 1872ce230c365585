"""Invoices and opportunities: joined once, grouped where their lines lie."""

from __future__ import annotations

from tradewind.operators import aggregates as agg
from tradewind.plans import datasets as ds
from tradewind.settings import PAIR
from tradewind.sources import tables as t


def test_lines_dealt_by_order_are_grouped_without_another_shuffle(spark, small_root, monkeypatch):
    columns = ["customer_name", "county", "dtl_extended_price"]
    invoices = lambda: agg.invoices_of(t.sales(spark, small_root, geography=True), columns)
    opps = lambda: agg.first_per_key(t.opportunities(spark, small_root), [*PAIR, "opp_id"], ["iswon"], ["create_dt"])
    rows = sorted(invoices().collect()), sorted(opps().collect())
    monkeypatch.setattr(t, "LINES_PER_TASK", 500)
    for dealt, whole in zip((invoices(), opps()), rows, strict=True):
        assert sorted(dealt.collect()) == whole
        assert "hashpartitioning(customer_num" not in dealt._jdf.queryExecution().executedPlan().toString()


def test_lines_are_joined_once_for_invoices_and_once_for_opportunities(spark, small_root, monkeypatch):
    written, write = [], ds.materialize
    monkeypatch.setattr(ds, "materialize", lambda df: written.append(df) or write(df))
    ds.prediction_test(t.sales(spark, small_root, geography=True), t.opportunities(spark, small_root))
    reads = [sum("lineitem" in f for f in df.inputFiles()) for df in written]
    assert reads == [1, 1, 0]  # what stacks and fills them reads no lines

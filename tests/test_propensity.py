"""Rows of the propensity model from narrow invoice days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.operators import aggregates as agg, windows as wn
from tradewind.plans import datasets as ds
from tradewind.settings import INVOICE, PAIR
from tradewind.sources import tables as t

DAY = dt.date


def test_days_of_invoices(spark):
    """First line up to the cutoff gives the day, lines without a number first, equal numbers by day."""
    rows = [
        ("a", "p", "1", 2, DAY(1998, 1, 1)), ("a", "p", "1", 1, DAY(1999, 5, 5)), ("a", "p", "1", 1, DAY(1999, 4, 4)), ("a", "p", "1", 0, DAY(2001, 1, 1)),
        ("a", "p", "2", None, DAY(1960, 2, 3)), ("a", "p", "2", -7, DAY(1950, 1, 1)), ("a", "p", "3", 1, DAY(2000, 6, 6)), ("a", "p", "4", 1, None),
    ]
    sales = spark.createDataFrame(rows, "customer_num string, srp_2_desc string, dtl_invoice_num string, dtl_line_num int, dtl_invoice_dt date")
    days = agg.invoice_days(sales, DAY(1999, 12, 31))
    assert sorted(r[2:] for r in days.collect()) == [
        ("1", DAY(1999, 4, 4), DAY(1999, 5, 5), DAY(2001, 1, 1)), ("2", DAY(1960, 2, 3), DAY(1960, 2, 3), None),
        ("3", None, None, DAY(2000, 6, 6)), ("4", None, None, None),
    ]
    assert [tuple(r) for r in agg.latest_invoice(days).collect()] == [("a", "p", "1", DAY(1999, 5, 5), DAY(2000, 6, 6))]


def wide_rows(sales):
    """The latest invoice of every pair from all columns of all invoices, as it was made before."""
    before = sales.where(F.col("dtl_invoice_dt") <= F.lit(ds.DEFAULTS.cutoff))
    invoices = agg.invoices_of(before, ds.PROPENSITY_COLS)
    gaps = agg.gap_stats(invoices).where("gap_std IS NOT NULL")
    return wn.last_row_per_pair(invoices).join(gaps, PAIR).select(*PAIR, *ds.PROPENSITY_COLS, "gap_mean", "gap_std")


@pytest.mark.parametrize("literal", [False, True])
def test_rows_equal_those_of_whole_invoices(spark, literal):
    sales = t.sales(spark, "/root/testdata/sf0.01", True).persist()
    got = ds.propensity_train(sales, literal=literal)
    want = wide_rows(sales)
    assert got.count() > 100
    assert got.select(*want.columns).exceptAll(want).isEmpty()
    if literal:
        assert got.count() == want.dropna().count()


def test_wide_columns_are_folded_for_the_latest_invoices_only(spark, small_root, monkeypatch):
    seen = []
    whole = agg.invoices_of
    monkeypatch.setattr(agg, "invoices_of", lambda sales, cols: seen.append(sales) or whole(sales, cols))
    rows = ds.propensity_train(t.sales(spark, small_root, True), literal=True)
    assert rows.count() <= seen[0].select(*INVOICE).distinct().count() == seen[0].select(*PAIR).distinct().count()

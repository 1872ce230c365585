"""Pair scoring joins the sales once, whatever is imputed from them, besides what product distances need."""

from __future__ import annotations

import pytest

from tradewind.plans import modelling
from tradewind.sources import tables


@pytest.mark.parametrize("name", ["propensity_lookup", "score_grid", "impute_predict", "impute_accuracy"])
def test_sales_are_joined_once(spark, small_root, monkeypatch, name):
    calls, sales = [], tables.sales

    def counted(*args):
        calls.append(args)
        return sales(*args)

    monkeypatch.setattr(tables, "sales", counted)
    modelling.product_distances(spark, small_root)  # joins sales for the products' features
    products = len(calls)
    assert not modelling.QUERIES[name](spark, small_root).isEmpty()
    assert len(calls) - products == products + 1


def test_two_values_are_imputed_by_the_same_joins(spark, small_root, monkeypatch):
    calls, whole = [], modelling.ln.impute_predict

    def kept(*args, **options):
        calls.append((args, options))
        return whole(*args, **options)

    monkeypatch.setattr(modelling.ln, "impute_predict", kept)
    assert not modelling.QUERIES["propensity_lookup"](spark, small_root).isEmpty()
    assert len(calls) == 1
    (requests, scored, *near), options = calls[0]
    both = whole(requests, scored, *near, **options)
    for value in options["values"]:
        single = whole(requests, scored.select("customer_num", "srp_2_desc", scored[value].alias("predicted")), *near)
        found = both.select("customer_num", "srp_2_desc", both[value].alias("outcome"), "imputed")
        assert found.count() == single.count() and found.exceptAll(single).isEmpty()

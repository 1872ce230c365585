"""The registered queries against their SQL on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tradewind.plans import oracle
from tests.check import compare, connection

#: Queries that fit models or run many rounds; tests/check.py compares these too.
SLOW = {"batch_predict", "rate_pairs", "als_fill", "logistic_mf", "smote_upsample"}
CHECKED = sorted(set(oracle.statements()) - SLOW)


@pytest.fixture(scope="module")
def con(small_root):
    return connection(small_root)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, small_root, con, name):
    got = entry.queries()[name](spark, small_root).toPandas()
    assert compare(got, con.execute(entry.oracle_sql()[name]).df()).startswith("ok")


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

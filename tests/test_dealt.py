"""Lines are dealt to as many tasks as their number asks for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewind.sources import tables as t


@pytest.mark.parametrize("name", ["sales", "opportunities"])
def test_a_task_joins_a_bounded_number_of_lines(spark, small_root, monkeypatch, name):
    rows = sorted(getattr(t, name)(spark, small_root).collect())
    monkeypatch.setattr(t, "LINES_PER_TASK", 500, raising=False)
    dealt = getattr(t, name)(spark, small_root)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert t.table(spark, small_root, "lineitem").count() > 5000 and max(sizes) < 1000
    assert sorted(dealt.collect()) == rows

"""Lists of a product are folded one by one."""

from __future__ import annotations

from tradewind.plans import building


def test_no_task_holds_the_elements_of_several_lists(spark, small_root):
    """Several distinct counts in one aggregate copy each row per list (Expand) into one hash table."""
    plan = building.QUERIES["product_details"](spark, small_root)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Expand" not in plan

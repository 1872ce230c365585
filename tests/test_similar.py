"""Approximate similar pairs, against exact shared counts."""

from __future__ import annotations

import random

import pytest

from tradewind.operators import similar
from tradewind.plans import building

SCHEMA = "customer_num string, element string"


def recall(got: list, lists: dict[str, set], k: int) -> float:
    """Share of the k nearest that were found; others at the same distance count as well."""
    found = hits = 0
    by = {}
    for r in got:
        assert r.other != r.id and r.d == pytest.approx(1 - len(lists[r.id] & lists[r.other]) / len(lists[r.id] | lists[r.other]), abs=1e-6)
        by.setdefault(r.id, []).append(r.d)
    for i, x in lists.items():
        nearest = sorted(1 - len(x & y) / len(x | y) for j, y in lists.items() if j != i)[:k]
        found += len(nearest)
        hits += sum(d <= nearest[-1] + 1e-6 for d in by.get(i, [])[:k]) if nearest else 0
    return hits / found


@pytest.mark.parametrize("cap", [400, 25])
def test_recall_against_exact_counts(spark, cap):
    draw = random.Random(8)
    bases = [set(draw.sample(range(400), 30)) for _ in range(40)]
    lists = {f"e{i}": {x for x in draw.choice(bases) if draw.random() < 0.9} | {draw.randrange(400)} for i in range(500)}
    lists |= {f"same{i}": set(range(50)) for i in range(150)}  # a group of copies beyond the cap
    rows = [(i, str(x)) for i, own in lists.items() for x in own]
    got = similar.approx_similar_pairs(spark.createDataFrame(rows + rows[:40], SCHEMA), "customer_num", k=5, cap=cap).collect()
    text = {i: set(map(str, x)) for i, x in lists.items()}
    assert recall(got, text, 5) >= 0.9
    assert max(r["rank"] for r in got) == 5 and len({(r.id, r.other) for r in got}) == len(got)


def test_recall_on_customers(spark):
    root = "/root/testdata/sf0.01"
    got = building.approx_similar_pairs(spark, root).collect()
    from pyspark.sql import functions as F

    from tradewind.plans import frames as fr
    from tradewind.sources import tables as t

    bought = fr.sales_before(spark, root).select("customer_num", F.concat(F.lit("bought "), "srp_1_desc").alias("element"))
    rented = t.rentals(spark, root).select("customer_num", F.concat(F.lit("rented "), "srp_2_desc").alias("element"))
    lists = {}
    for r in bought.union(rented).distinct().collect():
        lists.setdefault(r.customer_num, set()).add(r.element)
    found = recall(got, lists, 5)
    print("recall", found)
    assert found >= 0.9


def test_few_entities(spark):
    assert similar.approx_similar_pairs(spark.createDataFrame([], SCHEMA), "customer_num").collect() == []
    one = spark.createDataFrame([("a", "x"), ("b", None), (None, "x")], SCHEMA)
    assert similar.approx_similar_pairs(one, "customer_num").collect() == []
    two = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], SCHEMA)
    assert sorted(map(tuple, similar.approx_similar_pairs(two, "customer_num").collect())) == [("a", "b", 0.5, 1), ("b", "a", 0.5, 1)]


def test_equal_lists_are_compared_once(spark, monkeypatch):
    """Copies do not add to the pairs that are compared, and each entity still gets its own nearest others."""
    seen = []
    rows = [(f"{c}{i:02d}", str(x)) for c, own in {"a": range(6), "b": range(1, 7), "c": range(20, 30)}.items() for i in range(40) for x in own]
    signed = similar.signatures

    def counted(lists, key, size):
        seen.append(lists.count())
        return signed(lists, key, size)

    monkeypatch.setattr(similar, "signatures", counted)
    got = similar.approx_similar_pairs(spark.createDataFrame(rows, SCHEMA), "customer_num", k=5).collect()
    assert seen == [3] and len(got) == 600
    assert sorted((r["rank"], r.other, r.d) for r in got if r.id == "a02") == [(1, "a00", 0.0), (2, "a01", 0.0), (3, "a03", 0.0), (4, "a04", 0.0), (5, "a05", 0.0)]
    few = [r for r in rows if r[0] in ("a00", "a01", "b00", "b01", "b02", "b03")]
    got = similar.approx_similar_pairs(spark.createDataFrame(few, SCHEMA), "customer_num", k=4).collect()
    mine = sorted((r["rank"], r.other) for r in got if r.id == "a01")
    assert mine == [(1, "a00"), (2, "b00"), (3, "b01"), (4, "b02")]

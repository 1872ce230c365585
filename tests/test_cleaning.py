"""Cleaning edge cases on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import cleaning as fc
from tradewind.functions import dates
from tradewind.operators import cleaning as cl


def values(df, col):
    return [r[col] for r in df.collect()]


def test_every_null_token_and_near_misses(spark):
    cells = [*fc.NULL_TOKENS, " x", "NULL "]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").orderBy("i")
    assert values(cl.null_tokens(df), "c") == [None] * 15 + [" x", "NULL "]


def test_numbers_and_cast_report(spark):
    df = spark.createDataFrame([("1,234.5",), ("7%",), ("nan",), ("abc",), (None,)], "c string")
    assert values(cl.clean_numeric(df, ["c"]), "c") == [1234.5, 7.0, None, None, None]
    schema = T.StructType([T.StructField("c", T.DoubleType())])
    assert cl.cast_report(df, schema).collect()[0].n_failed == 1
    assert values(cl.cast_schema(df, schema), "c") == [1234.5, 7.0, None, None, None]
    with pytest.raises(ValueError):
        cl.cast_schema(df, schema, strict=True)


def test_cutoff_keeps_the_day_itself_before_and_drops_undated(spark):
    days = [dt.date(1999, 12, 31), dt.date(2000, 1, 1), None]
    before, after = cl.cutoff_split(spark.createDataFrame([(d,) for d in days], "d date"), "d")
    assert values(before, "d") == days[:1] and values(after, "d") == days[1:2]
    assert sorted(values(cl.cutoff_tags(spark.createDataFrame([(d,) for d in days], "d date"), "d"), "cutoff_tag")) == ["AFTER", "BEFORE"]


def test_replacement_names_and_codes(spark):
    rows = [("021 Brand#1", "21.0"), (None, "0"), (None, None)]
    df = spark.createDataFrame(rows, "replacement string, code string").withColumns({"own": F.lit("Own"), "own_code": F.lit("9")})
    assert values(cl.effective_product(df, "replacement", "own"), "updated") == ["Brand#1", "Own", "Own"]
    assert values(cl.replacement_code(df, "code", "own_code"), "code") == ["21", "9", "9"]


def test_constant_columns_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None, 1, "x"), (1, None, None, "y")], "a int, b int, c int, d string")
    flags = {r.column_name: r.is_constant for r in cl.constant_column_probe(df).collect()}
    assert flags == {"a": True, "b": True, "c": False, "d": False}
    assert cl.drop_constant_columns(df, keep=("a",)).columns == ["a", "c", "d"]


def test_day_difference_rounds_down(spark):
    rows = [
        (dt.datetime(2020, 1, 2, 1), dt.datetime(2020, 1, 1, 3)),
        (dt.datetime(2020, 1, 1, 3), dt.datetime(2020, 1, 2, 1)),
        (dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert values(df.select(dates.day_diff(F.col("a"), F.col("b")).alias("d")), "d") == [0, -1, 2]


def test_a_pair_silent_for_4635_days_counts_as_near(spark):
    days = dates.days_until_next(F.col("last"), F.lit(None).cast("date"), dt.date(1999, 12, 31), 5000)
    df = spark.createDataFrame([(dt.date(1987, 4, 23),), (dt.date(1987, 4, 24),)], "last date")
    near = cl.bin_outcome(df.withColumn("d", days), "d")
    assert values(near.orderBy("last"), "outcome") == [1, 0]


def test_labels(spark):
    df = spark.createDataFrame([(1, 0), (0, 1), (-1, -1), (-2, -1), (-3, -1)], "outcome int, imputed int")
    got = [(r.Remark, r.History) for r in cl.remark_labels(df).collect()]
    assert got[0] == ("Near Sale", "Known Pair") and got[1] == ("Far Sale", "New Pair")
    assert [g[0] for g in got[2:]] == [
        "No Remark (Unknown Customer)", "No Remark (Unknown Product)", "No Remark (Unknown Customer and Product)"
    ]

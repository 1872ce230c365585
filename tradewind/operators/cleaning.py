"""Cleaning: projections, filters and typed casts over raw extracts.

All of these are narrow: one pass, no shuffle.  The two probes are a single global aggregate whose
partial results are one row per task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as fc
from ..functions import dates, scoring
from ..settings import DEFAULTS


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def constant_column_probe(df: DataFrame) -> DataFrame:
    """``[column_name, is_constant]``; null counts as a value of its own."""
    rows = F.count(F.lit(1))

    def constant(c: str) -> Column:
        filled = F.count(c)
        one_value = F.coalesce(F.min(c) == F.max(c), F.lit(True))
        return one_value & ((filled == 0) | (filled == rows))

    flags = df.agg(*[constant(c).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("is_constant")) for c in df.columns]
    return flags.select(F.inline(F.array(*cells)))


def drop_constant_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop columns holding one value.  Runs the probe: its result is one row per column."""
    constant = {r.column_name for r in constant_column_probe(df).collect() if r.is_constant}
    return df.drop(*[c for c in df.columns if c in constant and c not in keep])


def null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[fc.blank_to_null(F.col(c), tokens).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def clean_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: fc.text_to_double(F.col(c)) for c in cols})


def cast_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``[column_name, n_failed]``: cells that hold text but do not parse as their type."""

    def failed(f: T.StructField) -> Column:
        text = fc.blank_to_null(F.col(f.name))
        return F.count_if(text.isNotNull() & fc.typed(F.col(f.name), f.dataType.simpleString()).isNull())

    counts = df.agg(*[failed(f).alias(f.name) for f in schema.fields])
    cells = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("n_failed")) for f in schema.fields]
    return counts.select(F.inline(F.array(*cells)))


def cast_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Text columns to their types, tokens first.  ``strict`` raises if any cell does not parse."""
    if strict:
        bad = cast_report(df, schema).where("n_failed > 0").collect()
        if bad:
            raise ValueError(f"cells that do not parse: { {r.column_name: r.n_failed for r in bad} }")
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return df.select(
        *[fc.typed(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def fix_values(df: DataFrame, repairs: dict[str, str], cols: list[str]) -> DataFrame:
    return df.replace(repairs, subset=cols)


def strip_code_prefix(df: DataFrame, col: str, n: int = 4) -> DataFrame:
    return df.withColumn(col, fc.without_code(F.col(col), n))


def replacement_code(df: DataFrame, col: str, own: str) -> DataFrame:
    return df.withColumn(col, fc.successor_code(F.col(col), F.col(own)))


def effective_product(df: DataFrame, replacement: str, own: str, out: str = "updated") -> DataFrame:
    return df.withColumn(out, fc.successor_name(F.col(replacement), F.col(own)))


def upper_name(df: DataFrame, col: str = "customer_name") -> DataFrame:
    return df.withColumn(col, F.upper(col))


def composite_key(df: DataFrame, a: str = "customer_num", b: str = "definitive_id") -> DataFrame:
    """Add ``unique_id``; it also stands in for an empty customer number."""
    return df.withColumn("unique_id", fc.joint_key(F.col(a), F.col(b))).withColumn(
        a, F.coalesce(F.nullif(F.col(a), F.lit("")), F.col("unique_id"))
    )


def curated_products(raw: DataFrame) -> DataFrame:
    """The curated list with its derived name, successor and successor code."""
    df = effective_product(
        raw.withColumn("srp_2_desc", fc.without_code(F.col("code_srp_2_desc"))), "replacement", "srp_2_desc"
    )
    return null_tokens(replacement_code(df, "replacement_srp_2_code", "srp_2_code"))


def cutoff_split(df: DataFrame, date_col: str, cutoff: dt.date = DEFAULTS.cutoff) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cutoff, and rows after it; undated rows are in neither."""
    return df.where(F.col(date_col) <= F.lit(cutoff)), df.where(F.col(date_col) > F.lit(cutoff))


def cutoff_tags(df: DataFrame, date_col: str, cutoff: dt.date = DEFAULTS.cutoff) -> DataFrame:
    """Both halves in one scan, told apart by ``cutoff_tag``."""
    tag = F.when(F.col(date_col) <= F.lit(cutoff), "BEFORE").otherwise("AFTER")
    return df.where(F.col(date_col).isNotNull()).withColumn("cutoff_tag", tag)


def filter_interacted(df: DataFrame) -> DataFrame:
    return df.where(F.col("IN_CSD") | F.col("IN_SFD") | F.col("IN_EDD"))


def filter_outcome(df: DataFrame, won: bool) -> DataFrame:
    return df.where(F.col("iswon") == ("True" if won else "False"))


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=cols)


def isin_filter(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(key), key, "left_semi")


def bin_outcome(df: DataFrame, days_col: str, k: int = DEFAULTS.near_sale_days) -> DataFrame:
    return df.withColumn("outcome", scoring.near(F.col(days_col), k))


def rating_from_probability(df: DataFrame, prob: str, pred: str, truth: str) -> DataFrame:
    return df.withColumn("rating", scoring.signed_rating(F.col(prob), F.col(pred), F.col(truth)))


def truncate_decimals(df: DataFrame, col: str, k: int) -> DataFrame:
    return df.withColumn(col, scoring.truncated(F.col(col), k))


def days_to_cutoff(df: DataFrame, date_col: str, cutoff: dt.date = DEFAULTS.cutoff) -> DataFrame:
    return df.withColumn("days_to_cutoff", dates.days_between(F.lit(cutoff), F.col(date_col)))


def remark_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"Remark": scoring.remark(F.col("outcome")), "History": scoring.history(F.col("imputed"))}
    )


def default_label(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def conditional_override(df: DataFrame, overrides: dict[str, str], key: str, col: str) -> DataFrame:
    """Set ``col`` for the listed values of ``key``; the list is part of the run's configuration."""
    chain = F.col(col)
    for k, v in overrides.items():
        chain = F.when(F.col(key) == k, v).otherwise(chain)
    return df.withColumn(col, chain)

"""Expressions that turn extract text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole-cell texts that stand for a missing value in the extracts.
NULL_TOKENS = [
    ".", "~", "-", "None", "none", "NONE", "nan", "NaN", "NAN", "*BLANK*", "", " ",
    "null", "NULL", "Null",
]


def blank_to_null(c: Column, tokens: list[str] | None = None) -> Column:
    """Null where the whole cell is a missing-value token (no trimming)."""
    return F.when(~c.isin(NULL_TOKENS if tokens is None else tokens), c)


def text_to_double(c: Column) -> Column:
    """Drop thousands commas and percent signs; the percentage is not divided by 100."""
    return F.nullif(F.translate(c, ",%", ""), F.lit("nan")).try_cast("double")


def typed(c: Column, data_type: str) -> Column:
    """Text to ``data_type``; null where it does not parse."""
    text = blank_to_null(c)
    if data_type in ("double", "float"):
        return text_to_double(text).cast(data_type)
    return text.try_cast(data_type)


def without_code(c: Column, n: int = 4) -> Column:
    """Drop the leading ``n`` characters of ``"123 NAME"``."""
    return F.substr(c, F.lit(n + 1))


def successor_code(c: Column, own: Column) -> Column:
    """Code of the replacing product; zero or missing means the product's own code."""
    code = F.coalesce(c.try_cast("double"), F.lit(0.0)).cast("bigint")
    return F.coalesce(F.nullif(code, F.lit(0).cast("bigint")).cast("string"), own)


def successor_name(replacement: Column, own: Column) -> Column:
    """Name of the replacing product, the product's own name if there is none."""
    return F.coalesce(F.nullif(without_code(replacement), F.lit("")), own)


def joint_key(a: Column, b: Column) -> Column:
    return F.concat(F.coalesce(a, F.lit("")), F.lit("_"), F.coalesce(b, F.lit("")))

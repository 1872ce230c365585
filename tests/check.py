"""Compare registered queries with their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connection(root: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype(float).round(6) + 0.0
        elif pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = pd.to_datetime(df[c]).dt.strftime("%Y-%m-%d")
        df[c] = df[c].astype(object).where(df[c].notna(), None)
        df[c] = [None if v is None else (v if isinstance(v, float) else str(v)) for v in df[c]]
        df[c] = [str(v) for v in df[c]]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind}
    a, b = canonical(got), canonical(want)
    bad = (a != b).any(axis=1)
    if bad.any():
        return f"{bad.sum()} rows differ, e.g.\n{a[bad].head(3)}\n{b[bad].head(3)} kinds={kinds}"
    return "ok" + (f" (kinds {kinds})" if kinds else "")


def main() -> None:
    args = sys.argv[1:]
    root = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connection(root), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = fn(spark, root)
            schema = got.schema
            got = got.toPandas()
            took = time.time() - start
            if name in oracle:
                result = compare(got, con.execute(oracle[name]).df())
            else:
                result = f"rows {len(got)} (no SQL)"
        except Exception as e:  # report every failing query, not just the first
            took, result = time.time() - start, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        ok = result.startswith(("ok", "rows ")) and "!=" not in result
        if not ok:
            bad.append(name)
        print(f"{name:28s} {took:6.2f}s {len(got) if ok else '':>7} {result}", flush=True)
    print("FAILED" if bad else "all fine", bad)


if __name__ == "__main__":
    main()

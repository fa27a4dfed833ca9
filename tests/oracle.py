"""Runs a registered query and its oracle SQL and compares rows, types and exact values."""

from __future__ import annotations

import time

import duckdb
import pandas as pd

from gridloom.checks.fixtures import BASE_TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        values = frame[name]
        if pd.api.types.is_datetime64_any_dtype(values):
            frame[name] = values.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_bool_dtype(values):
            frame[name] = values.astype(str).str.lower()
        elif pd.api.types.is_float_dtype(values) or pd.api.types.is_integer_dtype(values):
            as_float = values.astype(float) + 0.0
            frame[name] = as_float.map(lambda v: "null" if pd.isna(v) else repr(v))
        else:
            frame[name] = values.map(lambda v: "null" if v is None or v is pd.NaT or v != v else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True) if len(frame.columns) else frame


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    kinds = [
        f"{c}: {got[c].dtype} != {want[c].dtype}"
        for c in sorted(got.columns)
        if got[c].dtype.kind != want[c].dtype.kind and "O" in (got[c].dtype.kind + want[c].dtype.kind) and len(got)
    ]
    a, b = canonical(got), canonical(want)
    if not a.equals(b):
        bad = [c for c in a.columns if not a[c].equals(b[c])]
        at = next(i for i in range(len(a)) if not a.loc[i].equals(b.loc[i]))
        return f"values differ in {bad}, first at sorted row {at}: {a.loc[at].to_dict()} != {b.loc[at].to_dict()}"
    return "; ".join(kinds)


def check(spark, con, sf_dir: str, name: str, build, sql: str | None) -> tuple[str, int, float, float]:
    """(problem or empty, rows, Spark seconds, oracle seconds)."""
    start = time.time()
    got = build(spark, sf_dir).toPandas()
    spark_s = time.time() - start
    if sql is None:
        return "", len(got), spark_s, 0.0
    start = time.time()
    want = con.execute(sql).df()
    return differences(got, want), len(got), spark_s, time.time() - start

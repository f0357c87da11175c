"""Run queries next to their oracles and compare the rows."""

from __future__ import annotations

import glob
import os
from datetime import date, datetime

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (datetime, pd.Timestamp)):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, date):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, text: str) -> tuple[bool, str]:
    """Whether both hold the same rows, and what differs."""
    spark_cols, spark_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(text)
    duck_cols, duck_rows = canonical([d[0] for d in result.description], result.fetchall())
    if spark_cols != duck_cols:
        return False, f"columns {spark_cols} != {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return False, f"rows {len(spark_rows)} != {len(duck_rows)}; {spark_rows[:2]} {duck_rows[:2]}"
    for a, b in zip(spark_rows, duck_rows, strict=True):
        if a != b:
            return False, f"{spark_cols}: spark {a} duckdb {b}"
    return True, f"{len(spark_rows)} rows"

"""Runs a query on Spark and its SQL on DuckDB and compares rows as multisets."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x) -> str:
    if x is None or x is pd.NaT or isinstance(x, float) and math.isnan(x):
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float | decimal.Decimal):
        return repr(round(float(x), 6) + 0.0)
    if hasattr(x, "isoformat"):
        return pd.Timestamp(x).isoformat()
    return str(x)


def rows(columns, data) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in data)


def both(query, sql: str, spark, con, sf_dir: str):
    df = query(spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    return mine, rows([c[0] for c in cur.description], cur.fetchall())

"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check:
row count, column names, order-insensitive value multiset)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

SOURCE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in SOURCE:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return "D" + str(v)  # strict: both sides must leave decimals as double
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of_spark(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], out


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], out


def compare(df, con, sql) -> tuple[bool, str]:
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    cs, cd = Counter(sr), Counter(dr)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ; spark-only {only_s} duck-only {only_d}"
    return True, f"{len(sr)} rows"

"""Compare a Spark query with its DuckDB oracle: row count, column names and
an order-insensitive multiset of normalized rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(spark_df, con, sql: str) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    raw = rel.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in order) for r in raw]
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "values_match": Counter(s_rows) == Counter(d_rows),
    }
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    if not out["values_match"]:
        sc, dc = Counter(s_rows), Counter(d_rows)
        out["only_spark"] = list((sc - dc).elements())[:3]
        out["only_oracle"] = list((dc - sc).elements())[:3]
    out["ok"] = out["columns_match"] and out["values_match"]
    return out

"""Compare a Spark report with its DuckDB oracle: column names, row count and the
order-insensitive multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from testsupport.driver_fixture import DRIVER_TABLES


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
    }
    if out["columns_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).elements())[:5]
            out["only_oracle"] = list((b - a).elements())[:5]
    else:
        out["values_match"] = False
    out["ok"] = out["columns_match"] and out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out

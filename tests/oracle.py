"""Spark-vs-DuckDB comparison used by the tests and ``check_oracle.py``.

Order-insensitive: both results are sorted on all columns (by name) after
normalising values (dates to ISO strings, doubles rounded to 4 places).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canon(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols, s_vals = canon(sdf.columns, s_rows)
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_cols, d_vals = canon(d_cols_raw, d_rows)
    out = {"rows_spark": len(s_vals), "rows_duck": len(d_vals), "cols_match": s_cols == d_cols}
    out["values_match"] = out["cols_match"] and s_vals == d_vals
    if not out["values_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        diffs = [(a, b) for a, b in zip(s_vals, d_vals) if a != b]
        out["first_diffs"] = diffs[:3]
    return out

"""Run a Spark query and its DuckDB oracle on the same parquet tables and compare."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, sql: str, con) -> dict:
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_names) == sorted(d_names)}
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_names)
        out["oracle_cols"] = sorted(d_names)
        out["match"] = False
        return out
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    out["match"] = a == b
    if not out["match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
        out["names"] = sorted(s_names)
    return out

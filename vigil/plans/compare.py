"""Spark-vs-DuckDB comparison of contract queries (the local correctness gate).

Mirrors the driver's check: row count, sorted column names, and an
order-insensitive comparison of values.
"""

from __future__ import annotations

import math
import os

from ..fixtures import BASE_TABLES


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in BASE_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if not sql:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["status"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "values differ"
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out

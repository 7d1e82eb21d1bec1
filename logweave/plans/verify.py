"""Compare engine queries with their DuckDB oracles (row count, columns, values)."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    import os
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if out["columns_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["values_match"] = a == b
        if not out["values_match"]:
            sa, sb = set(a), set(b)
            out["only_spark"] = sorted(sa - sb, key=str)[:3]
            out["only_oracle"] = sorted(sb - sa, key=str)[:3]
    else:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    out["ok"] = out["columns_match"] and out.get("values_match", False) and len(s_rows) == len(d_rows)
    return out

"""Compare a registered Spark query with its DuckDB oracle SQL.

Row count, column names and types, and the multiset of rows (columns sorted
by name, doubles at 6 places) must agree.
"""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "None"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


SPARK_OF_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint"}


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_cols = sorted(sdf.columns)
    s_rows = sorted(tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect())
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_data = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_data),
           "spark_cols": s_cols, "oracle_cols": sorted(d_cols)}
    if sorted(d_cols) != s_cols:
        out["ok"] = False
        out["why"] = "columns differ"
        return out
    d_types = {d[0]: SPARK_OF_DUCK.get(str(d[1]).upper(), str(d[1]).lower()) for d in rel.description}
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    d_rows = sorted(tuple(_norm(r[idx[c]]) for c in s_cols) for r in d_data)
    out["ok"] = s_rows == d_rows and not type_diff
    if type_diff:
        out["why"] = {"types": type_diff}
        return out
    if not out["ok"]:
        sa, da = set(s_rows), set(d_rows)
        out["why"] = {"only_spark": sorted(sa - da)[:3], "only_oracle": sorted(da - sa)[:3]}
    return out

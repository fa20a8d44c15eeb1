"""Run registered queries against their DuckDB oracle and compare results.

Comparison mirrors the driver's: columns sorted by name, row count, column
names, and an order-insensitive multiset of normalised row values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

# Spark simple type names -> DuckDB type names of an equal result column.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v)  # exact: Spark and the oracle must agree bit for bit
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows), "columns": sorted(s_cols)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"column mismatch spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    s_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    d_types = {c[0]: str(t) for c, t in zip(cur.description, con.sql(sql).types)}
    wrong = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if wrong:
        out["status"] = f"type mismatch {wrong}"
        return out
    a = rows_multiset(s_cols, s_rows)
    b = rows_multiset(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "value mismatch"
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out

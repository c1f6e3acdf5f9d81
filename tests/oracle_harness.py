"""Run a registered query and its DuckDB oracle on the same tables and compare
row count, column names/types and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import os

EXACT = os.environ.get("ORACLE_EXACT") == "1"

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols)}
    hs, ls = digest(srows, scols)
    hd, ld = digest(drows, dcols)
    out["hash_match"] = hs == hd
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(scols), sorted(dcols)
    if not out["hash_match"]:
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    return out

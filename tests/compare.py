"""Compare registered queries with their SQL on DuckDB (order of rows ignored)."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=repr)


def check(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t
    if sql is None:
        return None, len(got), t_spark, ""
    rel = con.sql(sql)
    want = rel.fetchall()
    a, b = sorted(df.columns), sorted(rel.columns)
    if a != b:
        return False, len(got), t_spark, f"columns {a} <> {b}"
    x, y = rows(df.columns, got), rows(rel.columns, want)
    if x == y:
        kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        odd = [c for c, k in kinds.items() if k == "HUGEINT" or k.startswith("DECIMAL")]
        return True, len(got), t_spark, f"odd types {odd}" if odd else ""
    bad = next(((p, q) for p, q in zip(x, y) if p != q), (None, None))
    return False, len(got), t_spark, f"{len(x)} <> {len(y)} rows; first: {bad[0]} <> {bad[1]} ({a})"

"""Compares a Spark result with DuckDB's on the same tables: columns, rows, values."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def duck(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}" if v else "0"
    if isinstance(v, dt.datetime):
        return v.isoformat(timespec="microseconds")
    return f"{type(v).__name__}:{v}"


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), _sorted(df.collect(), df.columns)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), _sorted(cur.fetchall(), names)


def explain_difference(left, right, n: int = 3) -> str:
    a, b = set(left) - set(right), set(right) - set(left)
    return f"rows {len(left)} / {len(right)}; only left {sorted(a)[:n]}; only right {sorted(b)[:n]}"

"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows on both sides, column names equal, exact
match of the sorted rows, and match within a relative 1e-9 for doubles.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return (0, "")
    try:
        if isinstance(v, float) and math.isnan(v):
            return (0, "")
    except Exception:
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        v = int(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        if tol:
            return (1, float(f"{f:.9g}"))
        return (1, f)
    return (2, str(v))


def rows_of(cols, records, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i], tol) for i in order) for r in records)


def compare(spark, con, name, q, sf_dir):
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    if q.sql is None:
        return f"{name:34s} spark_rows={len(s_rows):6d} (no oracle) {t1 - t0:5.1f}s"
    res = con.execute(q.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    cols_ok = sorted(s_cols) == sorted(d_cols)
    exact = cols_ok and rows_of(s_cols, s_rows, False) == rows_of(d_cols, d_rows, False)
    tol = cols_ok and rows_of(s_cols, s_rows, True) == rows_of(d_cols, d_rows, True)
    flag = "OK " if exact else ("~OK" if tol else "BAD")
    extra = "" if cols_ok else f" cols spark={s_cols} duck={d_cols}"
    return (f"{flag} {name:30s} rows {len(s_rows):6d}/{len(d_rows):6d} exact={exact} tol={tol} "
            f"{t1 - t0:5.1f}s{extra}")


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from cardpanel.plans.catalog import REGISTRY
    from cardpanel.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        try:
            print(compare(spark, con, name, q, sf_dir), flush=True)
        except Exception as e:  # report and continue
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)


if __name__ == "__main__":
    main()

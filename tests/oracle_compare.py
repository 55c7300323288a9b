"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]

Per key: row counts, column names, and an order-insensitive comparison of
the values (columns sorted by name, rows sorted, floats as they are).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(v)
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    try:
        import pandas as pd
        if v is pd.NaT:
            return "<null>"
        if isinstance(v, pd.Timestamp):
            return str(v.to_pydatetime())
    except Exception:
        pass
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def compare(spark, con, sf_dir: str, key: str, fn, sql: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    scols, s = canon(sdf.columns, srows)
    dcols, d = canon(dcols, drows)
    out = {"key": key, "spark_rows": len(s), "oracle_rows": len(d), "cols_match": scols == dcols,
           "values_match": s == d, "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    if scols != dcols:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    elif s != d:
        ss, dd = set(s), set(d)
        out["only_spark"] = sorted(ss - dd)[:3]
        out["only_oracle"] = sorted(dd - ss)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from shelfspark.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    Q, O = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(Q):
        if k not in O:
            t0 = time.time()
            n = Q[k](spark, sf_dir).count()
            print({"key": k, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, con, sf_dir, k, Q[k], O[k])
        except Exception as e:  # report and continue
            r = {"key": k, "error": repr(e)[:800]}
        ok = r.get("values_match") and r.get("cols_match")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

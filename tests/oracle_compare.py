"""Run a catalogue query on Spark and its oracle SQL on DuckDB, and compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 6))
    if isinstance(v, dt.datetime):
        return (1, v.isoformat())
    if isinstance(v, dt.date):
        return (1, v.isoformat())
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, key: str, sf_dir: str, queries: dict, sqls: dict) -> dict:
    t0 = time.time()
    sdf = queries[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if key not in sqls:
        out["status"] = "no-oracle"
        return out
    res = con.execute(sqls[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["status"] = f"values differ ({len(a)} vs {len(b)} rows), first: {diff}"
    return out


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from blotter.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(queries())
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, sf_dir, qs, sqls)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

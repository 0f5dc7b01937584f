"""Runs queries beside their SQL in DuckDB: ``python tests/compare.py [NAME...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

FOLDER = os.environ.get("COMPARE_DIR", "/root/testdata/sf0.01")


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        src = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"create view {p.stem} as select * from read_parquet('{src}')")
    return con


def plain(value):
    if isinstance(value, float):
        return f"{value:.6g}" if value == value else "nan"
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return str([plain(x) for x in value])
    if isinstance(value, dict):
        return str({k: plain(v) for k, v in value.items()})
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, folder, run, sql):
    df = run(spark, folder)
    got = rows(df.columns, df.collect())
    rel = con.sql(sql)
    want = rows(rel.columns, rel.fetchall())
    return got, want


if __name__ == "__main__":
    import __spark_entry__ as e

    from corpusloom.session import local_session

    spark, con = local_session(cores=8), duck(FOLDER)
    queries, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name in sys.argv[1:] or queries:
        began = time.time()
        try:
            if name in sql:
                got, want = compare(spark, con, FOLDER, queries[name], sql[name])
                same = got == want
                print(name, "same" if same else "DIFFERENT", len(got[1]), len(want[1]), f"{time.time() - began:.1f}s", flush=True)
                if not same:
                    bad += 1
                    print(" ", got[0], want[0])
                    a, b = set(got[1]), set(want[1])
                    print("  only here:", list(a - b)[:3], "\n  only there:", list(b - a)[:3])
            else:
                print(name, "rows", queries[name](spark, FOLDER).count(), f"{time.time() - began:.1f}s", flush=True)
        except Exception as x:
            bad += 1
            print(name, "FAILED", repr(x)[:1500], flush=True)
    sys.exit(bad > 0)

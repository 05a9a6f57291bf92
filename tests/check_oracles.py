"""Compare registered queries with their DuckDB SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf: str):
    """(ok, detail, seconds) for one query."""
    t = time.time()
    df = entry.queries()[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"rows={len(got[1])} (no SQL)", took
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} vs {want[0]}", took
    if len(got[1]) != len(want[1]):
        return False, f"rows {len(got[1])} vs {len(want[1])}", took
    diff = [(a, b) for a, b in zip(got[1], want[1]) if repr(a) != repr(b)]
    if diff:
        return False, f"{len(diff)} of {len(got[1])} rows differ, e.g. {str(diff[0][0])[:600]} vs {str(diff[0][1])[:600]}", took
    return True, f"rows={len(got[1])}", took


if __name__ == "__main__":
    from threadlens import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8, spark__ui__enabled="false",
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    con, bad = duck(sf), []
    for name in sys.argv[2:] or entry.queries():
        try:
            ok, detail, took = compare(spark, con, name, sf)
        except Exception as exc:  # report every query
            ok, detail, took = False, f"{type(exc).__name__}: {str(exc)[:1500]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {took:6.2f}s {detail}", flush=True)
        bad += [] if ok else [name]
    print(f"{len(bad)} failed: {bad}")

"""Compare registered queries with their SQL: ``python -m workload.check [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from snaptrend.session import build_session
from workload.oracle import ORACLE
from workload.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"{value:.10g}"
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            mine = table_of(frame.columns, [tuple(r) for r in frame.collect()])
        except Exception as err:  # report and go on with the next query
            print(f"FAIL {name}: {str(err)[:600]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in ORACLE:
            print(f"rows {name}: {len(mine[1])} in {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            cursor = con.execute(ORACLE[name])
            theirs = table_of([c[0] for c in cursor.description], cursor.fetchall())
        except Exception as err:
            print(f"FAIL {name}: sql {str(err)[:600]}", flush=True)
            bad += 1
            continue
        same = mine == theirs
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(mine[1])} rows, {took:.1f}s, sql {time.time() - start:.1f}s", flush=True)
        if not same:
            bad += 1
            if mine[0] != theirs[0]:
                print("  columns", mine[0], theirs[0])
            a, b = set(mine[1]), set(theirs[1])
            print("  rows", len(mine[1]), len(theirs[1]), "only here", sorted(a - b)[:2], "only sql", sorted(b - a)[:2])
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)

"""Run registered queries against their DuckDB counterparts.

    python check.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import tempfile
import time
import traceback

import duckdb

from corpusloom.catalogue import ORACLES, QUERIES
from corpusloom.workspace import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows]), sorted(columns)


def compare(spark, con, name, folder):
    start = time.time()
    frame = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return f"rows only: {len(rows)}", took, 0.0
    start = time.time()
    cursor = con.execute(ORACLES[name])
    want = cursor.fetchall()
    sql_took = time.time() - start
    got, got_columns = canonical(frame.columns, rows)
    wanted, want_columns = canonical([d[0] for d in cursor.description], want)
    if got_columns != want_columns:
        return f"COLUMNS {got_columns} != {want_columns}", took, sql_took
    if got != wanted:
        extra = [r for r in got if r not in set(wanted)][:3]
        lacking = [r for r in wanted if r not in set(got)][:3]
        return f"DIFFER {len(got)} vs {len(wanted)} rows\n   spark {extra}\n   duck  {lacking}", took, sql_took
    return f"ok {len(got)} rows", took, sql_took


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-", dir="/tmp")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in QUERIES:
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        try:
            verdict, took, sql_took = compare(spark, con, name, folder)
        except Exception as error:  # report every query
            verdict, took, sql_took = f"FAILED {type(error).__name__}: {str(error)[:1500]}", 0, 0
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:40s} {took:6.2f}s duck {sql_took:6.2f}s  {verdict}", flush=True)
    print(f"{bad} not matching")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())

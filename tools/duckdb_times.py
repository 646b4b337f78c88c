"""

Usage: python tools/duckdb_times.py [sf_dir] [threads] [name ...]
Prints the median of three runs of each query, result rows fetched.
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NAMES = ["fct_stop_events", "punctuality_by_route", "punctuality_by_stop", "check_not_null", "rt_freshness", "flatten_trip_updates"]


def main(sf_dir: str = "/root/testdata/sf0.1", threads: str = "8", *names: str) -> None:
    from headway.plans.oracle import oracle_sql

    sql = oracle_sql()
    con = duckdb.connect(config={"threads": int(threads)})
    for table in ("orders", "lineitem", "supplier", "nation", "events", "documents"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    for name in names or NAMES:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            con.sql(f"CREATE OR REPLACE TEMP TABLE result AS {sql[name]}")
            times.append(time.perf_counter() - start)
        print(f"{name}\t{statistics.median(times):.2f} s")


if __name__ == "__main__":
    main(*sys.argv[1:])

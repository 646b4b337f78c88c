"""Command line: ``python -m headway <command> ...``.

  build    --root LANDING --out WAREHOUSE [--fact-form resolved|range]
           build the four marts from a landing zone (full rebuild)
  query    --warehouse WAREHOUSE NAME
           run one dashboard query over stored marts and print it
           (punctuality_by_route, punctuality_by_hour, punctuality_by_stop,
           delay_distribution, total_stop_events)
  check    --root LANDING --warehouse WAREHOUSE [--now ISO] [--bounds-severity warn]
           freshness of both realtime feeds and the schedule, mart readiness,
           and every data test of the marts; exit status 1 when a feed or the
           schedule is stale, the schedule or a mart is missing or empty, or a
           data test fails
  ingest   --root LANDING --archives GLOB [--now ISO]
           ingest schedule archives (zip files)
  publish  --warehouse WAREHOUSE --target ROOT
           truncating load of the marts into another root

Results print whole, row by row, as tab-separated text; all work runs on Spark.  The Spark master and
configuration come from the environment (spark-submit / spark-defaults).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, Row, SparkSession

from headway.operators import constraints, quality
from headway.plans import sinks
from headway.plans.ingest import ingest_archives
from headway.plans.warehouse import MART_TABLES, Marts, Warehouse, write_marts
from headway.sources.newest import newest_poll
from headway.sources.readers import load_landing, read_manifest

DASHBOARD = (
    "punctuality_by_route",
    "punctuality_by_hour",
    "punctuality_by_stop",
    "delay_distribution",
    "total_stop_events",
)


def _print(df: DataFrame) -> list[Row]:
    """Every row of a result, as text; rows stream from Spark one partition at a time."""
    print("\t".join(df.columns))
    rows = []
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))
        rows.append(row)
    return rows


def _now(text: str | None) -> dt.datetime:
    if not text:
        return dt.datetime.now(dt.timezone.utc)
    t = dt.datetime.fromisoformat(text)
    return t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="headway", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--root", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--fact-form", default="resolved", choices=("resolved", "range"))
    q = sub.add_parser("query")
    q.add_argument("--warehouse", required=True)
    q.add_argument("name", choices=DASHBOARD)
    c = sub.add_parser("check")
    c.add_argument("--root", required=True)
    c.add_argument("--warehouse", required=True)
    c.add_argument("--now")
    c.add_argument("--bounds-severity", default="error", choices=("error", "warn"))
    i = sub.add_parser("ingest")
    i.add_argument("--root", required=True)
    i.add_argument("--archives", required=True)
    i.add_argument("--now")
    p = sub.add_parser("publish")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--target", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"headway-{args.cmd}").getOrCreate()
    if args.cmd == "build":
        write_marts(Warehouse(load_landing(spark, args.root), fact_form=args.fact_form), args.out)
    elif args.cmd == "query":
        _print(getattr(Marts.read(spark, args.warehouse), args.name)())
    elif args.cmd == "check":
        now, found = _now(args.now), []
        for feed in ("trip_updates", "vehicle_positions"):
            found += _print(quality.rt_freshness_status(newest_poll(spark, args.root, feed), feed, [now]))
        found += _print(quality.static_freshness_status(read_manifest(spark, args.root), [now]))
        ready = _print(quality.readiness_of_root(spark, args.warehouse, MART_TABLES))
        if all(r.status == "ready" for r in ready):
            found += _print(constraints.of_marts(Marts.read(spark, args.warehouse), constraints.declared(args.bounds_severity)))
        return int(any(r.status in ("stale", "missing", "empty", "fail") for r in [*found, *ready]))
    elif args.cmd == "ingest":
        _print(ingest_archives(spark, args.archives, args.root, now=_now(args.now) if args.now else None))
    elif args.cmd == "publish":
        m = Marts.read(spark, args.warehouse)
        _print(sinks.publish_marts(spark, {t: getattr(m, t) for t in MART_TABLES}, args.target))
    return 0


if __name__ == "__main__":
    sys.exit(main())

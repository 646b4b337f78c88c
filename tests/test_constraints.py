"""Declared tests compiled to one scan a mart equal the tests one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.operators import constraints as ct
from headway.operators import quality
from headway.plans.warehouse import MART_TABLES, write_marts


def rows(df):
    return sorted(tuple(r) for r in df.select("model", "test", "column_name", "failures", "status").collect())


def faulty(golden):
    """The golden marts with every kind of fault."""
    fact = golden.fct_stop_events
    wrong = fact.limit(1).withColumns({"stop_id": F.lit("nowhere"), "arrival_delay_seconds": F.lit(9999)})
    lost = fact.limit(1).withColumns({"stop_id": F.lit(None).cast("string"), "trip_id": F.lit(None).cast("string")})
    marts = {t: getattr(golden, t) for t in MART_TABLES}
    marts["fct_stop_events"] = fact.unionByName(wrong).unionByName(wrong).unionByName(lost)
    marts["dim_stops"] = marts["dim_stops"].unionByName(marts["dim_stops"].limit(1)).unionByName(marts["dim_stops"].limit(1).withColumn("stop_id", F.lit(None).cast("string")))
    marts["dim_trips"] = marts["dim_trips"].unionByName(marts["dim_trips"].limit(1).withColumn("route_id", F.lit("L0")))
    return marts


def test_equals_the_tests_one_by_one(spark, golden):
    class Marts:
        pass

    broken = Marts()
    broken.__dict__.update(faulty(golden))
    got = rows(ct.of_marts(faulty(golden), ct.declared("warn")))
    assert got == rows(quality.data_test_summary(broken, bounds_severity="warn"))
    failing = {(m, t, c): (n, s) for m, t, c, n, s in got if n}
    assert failing["fct_stop_events", "relationships", "stop_id"] == (2, "fail")
    assert failing["fct_stop_events", "delay_bounds", "arrival_delay_seconds"] == (2, "warn")
    assert failing["dim_stops", "unique", "stop_id"] == (1, "fail") and failing["dim_stops", "not_null", "stop_id"] == (1, "fail")


def test_one_scan_a_mart(spark, golden, tmp_path):
    from headway.plans.warehouse import Marts

    root = str(tmp_path / "marts")
    write_marts(golden, root)
    plan = ct.of_marts(Marts.read(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(MART_TABLES)


def test_empty_marts_pass(spark, golden):
    empty = {t: getattr(golden, t).limit(0) for t in MART_TABLES}
    assert {r[4] for r in rows(ct.of_marts(empty))} == {"pass"} and len(rows(ct.of_marts(empty))) == len(ct.declared())

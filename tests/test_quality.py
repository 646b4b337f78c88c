"""Freshness statuses and data tests."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators import quality
from headway.plans import sinks
from headway.plans.ingest import with_poll_partitions
from headway.sources.readers import read_realtime

UTC = dt.timezone.utc


def _rt(spark, root, ts):
    df = spark.createDataFrame([(ts,)], "feed_timestamp bigint")
    for f in schemas.TRIP_UPDATES.fields[1:]:
        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    sinks.write_realtime(with_poll_partitions(df, ts), root, "trip_updates")
    return read_realtime(spark, root, "trip_updates")


NOON = dt.datetime(2031, 5, 2, 10, 0, tzinfo=UTC)  # midday in Rome


def _ago(**delta):
    return int((NOON - dt.timedelta(**delta)).timestamp())


def test_latest_rt_feed_timestamp(spark, tmp_root):
    empty = read_realtime(spark, tmp_root, "trip_updates")
    assert quality.latest_rt_feed_timestamp(empty).first()[0] is None and quality.newest_date(empty) is None
    _rt(spark, tmp_root, _ago(minutes=1))
    both = _rt(spark, tmp_root, _ago(hours=30))  # an older poll landing late
    assert both.count() == 2
    assert quality.latest_rt_feed_timestamp(both).first()[0] == _ago(minutes=1)
    assert quality.newest_date(both) == NOON.date()
    assert quality.latest_rt_feed_timestamp(both, since=dt.date(2031, 5, 3)).first()[0] is None


def test_newest_date_reads_no_data_column(spark, tmp_root):
    rt = _rt(spark, tmp_root, _ago(days=400))
    plan = rt.agg(F.max("date"))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in plan


def test_realtime_age_decides_whatever_its_size(spark, tmp_root):
    rt = _rt(spark, tmp_root, _ago(seconds=600))
    assert quality.check_rt_freshness(rt, "trip_updates", NOON) == "fresh"  # exactly the limit
    for late in (dt.timedelta(microseconds=1), dt.timedelta(seconds=1), dt.timedelta(days=11), dt.timedelta(days=900)):
        with pytest.raises(quality.StaleDataError, match="no trip_updates for"):
            quality.check_rt_freshness(rt, "trip_updates", NOON + late)


def test_quiet_hours_and_no_data(spark, tmp_root):
    night = dt.datetime(2031, 5, 3, 1, 0, tzinfo=UTC)  # three at night in Rome
    assert quality.check_rt_freshness(None, "trip_updates", night) == "quiet"  # nothing is read
    none = read_realtime(spark, tmp_root, "trip_updates")
    assert quality.check_rt_freshness(none, "trip_updates", NOON) == "no_data"
    with pytest.raises(ValueError, match="time zone"):
        quality.rt_freshness_status(none, "trip_updates", [NOON.replace(tzinfo=None)])


def test_static_freshness(spark):
    def downloaded(*times):
        return spark.createDataFrame([("v", t, "", "") for t in times], schemas.VERSIONS)

    limit = NOON - quality.STATIC_MAX_AGE
    assert quality.check_static_freshness(downloaded(limit.strftime("%Y-%m-%dT%H:%M:%S"), "2019-01-01T00:00:00"), NOON) == "fresh"
    # the same instant by another clock, and half a second earlier
    zoned = downloaded(limit.astimezone(dt.timezone(dt.timedelta(hours=5, minutes=30))).isoformat())
    assert quality.check_static_freshness(zoned, NOON) == "fresh"
    with pytest.raises(quality.StaleDataError, match="14 days old"):
        quality.check_static_freshness(downloaded((limit - dt.timedelta(milliseconds=500)).strftime("%Y-%m-%dT%H:%M:%S.%f")), NOON)
    with pytest.raises(quality.StaleDataError, match="lists no schedule"):
        quality.check_static_freshness(downloaded(), NOON)


def test_data_tests(spark, golden):
    assert quality.unique_failures(golden.dim_stops, "stop_id").count() == 0
    dup = golden.dim_stops.unionByName(golden.dim_stops.limit(1))
    assert quality.unique_failures(dup, "stop_id").count() == 1
    s = quality.not_null_summary("dim_stops", golden.dim_stops, ["stop_id", "stop_name"]).collect()
    assert {(r.column_name, r.failures, r.status) for r in s} == {("stop_id", 0, "pass"), ("stop_name", 0, "pass")}
    orphan = golden.fct_stop_events.withColumn("stop_id", F.lit("nowhere"))
    rel = quality.relationship_failures(orphan, "stop_id", golden.dim_stops, "stop_id")
    assert rel.count() == 4
    summary = quality.summarize("fct", "relationships", "stop_id", rel, severity="warn").first()
    assert (summary.failures, summary.status) == (4, "warn")
    bad = golden.fct_stop_events.withColumn("arrival_delay_seconds", F.lit(4000))
    assert quality.delay_bound_violations(bad).count() == 4
    assert quality.delay_bound_violations(golden.fct_stop_events).count() == 0


def test_mart_readiness(spark, golden, tmp_path):
    frames = {
        "fct_stop_events": golden.fct_stop_events,
        "empty": golden.fct_stop_events.limit(0),
        "missing": quality.read_mart_or_none(spark, str(tmp_path / "nope")),
    }
    got = {r.table_name: (r.status, r.n_rows) for r in quality.mart_readiness(spark, frames).collect()}
    assert got == {"fct_stop_events": ("ready", 4), "empty": ("empty", 0), "missing": ("missing", None)}


def test_data_test_summary_covers_all_declared_tests(spark, golden):
    rows = quality.data_test_summary(golden, bounds_severity="warn").collect()
    assert len(rows) == 15  # 2 unique + 10 not_null + 2 relationships + 1 bounds
    assert all(r.status == "pass" for r in rows)

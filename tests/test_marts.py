"""Hand-worked tests of staging, dimensions, the fact and the aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from headway.operators import marts, staging
from headway.plans.warehouse import Marts, Warehouse
from tests.conftest import SPRING, WINTER


def _fact(df):
    return {(str(r.service_date), r.trip_id, r.stop_sequence): r for r in df.collect()}


def test_fact(golden):
    fact = _fact(golden.fct_stop_events)
    delays = {k: (r.arrival_delay_seconds, r.departure_delay_seconds) for k, r in fact.items()}
    assert delays == {
        ("2031-03-05", "m100", 1): (0, 0),
        ("2031-03-12", "m100", 1): (45, 50),
        ("2031-03-12", "m100", 2): (-90, -80),
        ("2031-03-12", "m200", 1): (400, 410),
    }
    # each day's newest schedule: only winter covers the 5th
    assert {k[0]: r.gtfs_version for k, r in fact.items()} == {"2031-03-05": WINTER[:12], "2031-03-12": SPRING[:12]}
    assert fact["2031-03-05", "m100", 1].scheduled_arrival == dt.datetime(2031, 3, 5, 9, 10)
    assert fact["2031-03-12", "m100", 1].scheduled_arrival == dt.datetime(2031, 3, 12, 9, 12)
    assert fact["2031-03-12", "m100", 1].actual_departure == dt.datetime(2031, 3, 12, 9, 13, 20)
    # ten to one at night belongs to the service day before
    night = fact["2031-03-12", "m200", 1]
    assert night.scheduled_arrival == dt.datetime(2031, 3, 13, 0, 50)
    assert night.actual_arrival == dt.datetime(2031, 3, 13, 0, 56, 40)


def test_scheduled_hour_is_wall_clock(spark, golden):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        hours = golden.fct_stop_events.groupBy(F.hour("scheduled_arrival").alias("h")).count().collect()
        assert {r.h: r["count"] for r in hours} == {9: 3, 0: 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dims(golden):
    assert {r.stop_id: (r.stop_name, r.stop_lat) for r in golden.dim_stops.collect()} == {
        "harbour": ("Harbour Gate", 54.1),
        "mill": ("Old Mill", 54.2),
        "depot": ("Depot", None),
    }
    assert {r.route_id: r.route_short_name for r in golden.dim_routes.collect()} == {"L7": "Line 7", "N2": "Night 2"}
    trips = {(r.version, r.trip_id, r.route_short_name) for r in golden.dim_trips.collect()}
    assert trips == {(v[:12], t, n) for v in (WINTER, SPRING) for t, n in (("m100", "Line 7"), ("m200", "Night 2"))}


def test_range_and_resolved_fact_agree(golden):
    wh_range = Warehouse(golden.raw, fact_form="range")
    a = golden.fct_stop_events
    b = wh_range.fct_stop_events
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_analytics(golden):
    m = Marts.of(golden)
    routes = [tuple(r) for r in m.punctuality_by_route().collect()]
    assert routes == [("N2", "Night 2", 1, 400.0, 400.0, 0.0), ("L7", "Line 7", 3, -15.0, 0.0, 66.7)]  # worst first
    assert [(r.hour_of_day, r.total_events) for r in m.punctuality_by_hour().collect()] == [(0, 1), (9, 3)]
    stops = {r.stop_id: (r.total_events, r.avg_delay_sec, r.stop_lat) for r in m.punctuality_by_stop().collect()}
    assert stops == {"harbour": (2, 22.5, 54.1), "mill": (2, 155.0, 54.2)}
    hist = [(r.bucket_order, r.event_count) for r in m.delay_distribution().collect()]
    assert hist == [(1, 1), (3, 2), (6, 1)]  # -90; 0 and 45; 400
    assert m.total_stop_events().first().total_events == 4


def test_status_filter_precedes_dedup(golden):
    """A newer SKIPPED poll must not hide the last SCHEDULED one, and a newer
    SCHEDULED poll with no delays removes the event (no fallback)."""
    seen = golden.raw.trip_updates
    later = F.col("feed_timestamp") + 60
    cancelled = seen.where("trip_id = 'm100'").withColumns({"feed_timestamp": later, "schedule_relationship": F.lit(1)})
    silent = seen.where("trip_id = 'm200'").withColumns(
        {"feed_timestamp": later, "arrival_delay": F.lit(None).cast("int"), "departure_delay": F.lit(None).cast("int")}
    )
    stg = staging.stg_trip_updates(seen.unionByName(cancelled).unionByName(silent))
    fact = _fact(marts.fct_stop_events(stg, golden.stg_gtfs_versions, golden.stg_stop_times))
    assert sorted(k[1:] for k in fact) == [("m100", 1), ("m100", 1), ("m100", 2)]


def test_empty_window_version_never_matches(spark, golden):
    from headway.operators.versions import version_days

    v = spark.createDataFrame(
        [("x" * 64, "2026-01-01T00:00:00", "", "20260801"), ("y" * 64, "2026-01-01", "20260802", "20260801")],
        "version string, downloaded_at string, valid_from string, valid_to string",
    )
    assert version_days(v).count() == 0


def test_strict_and_tolerant_staging(spark):
    import pytest

    st = spark.createDataFrame(
        [("t", "8:xx:00", "08:01:00", "S1", "1", "v"), ("t", "08:05:00", "08:06:00", "S1", "2", "v")],
        "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence string, version string",
    )
    with pytest.raises(Exception):
        staging.stg_stop_times(st).collect()
    rows = sorted(staging.stg_stop_times(st, as_seconds=True, strict=False).collect(), key=lambda r: r.stop_sequence)
    assert rows[0].arrival_secs is None and rows[1].arrival_secs == 29100
    cal = spark.createDataFrame([("1", "2026-07-30", "x", "v")], "service_id string, date string, exception_type string, version string")
    r = staging.stg_calendar_dates(cal, strict=False).first()
    assert r.service_date is None and r.exception_type is None

"""Dimensions and the stop-event fact (M1-M4).

Order of operations in the fact is part of its meaning:

1. only SCHEDULED observations (staging);
2. one observation per (service_date, trip_id, stop_sequence) -- the newest
   ``feed_timestamp``; the version is the newest download covering the date;
3. only then drop rows whose two delays are both NULL (no fallback to an
   older poll);
4. inner join to the chosen version's stop_times (no fallback to an older
   version); scheduled = service-day midnight + GTFS offset on the naive
   wall clock, actual = scheduled + delay.

``fct_stop_events`` (default) reduces observations first and attaches the
per-day version with a broadcast equi-join; ``fct_range`` is the literal
form (range join, then rank over the multiplied rows).  Tests assert they
are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.dates import service_midnight
from headway.functions.gtfs_time import seconds_interval
from headway.operators.dedup import latest_by_aggregate, latest_by_window, rank_latest
from headway.operators.versions import (
    attach_versions,
    join_manifest_by_prefix,
    newest_version_per_day,
    version_days,
)

EVENT_KEY = ["service_date", "trip_id", "stop_sequence"]

# Newest observation first; the remaining columns only break ties between
# polls with equal feed_timestamp (the reference leaves those unordered).
OBS_ORDER = [
    "feed_timestamp",
    "stop_id",
    "arrival_delay",
    "departure_delay",
    "vehicle_id",
    "entity_id",
    "route_id",
    "direction_id",
    "vehicle_label",
]

FACT_COLUMNS = [
    "service_date",
    "trip_id",
    "route_id",
    "direction_id",
    "stop_sequence",
    "stop_id",
    "vehicle_id",
    "vehicle_label",
    "gtfs_version",
    "scheduled_arrival",
    "scheduled_departure",
    "arrival_delay_seconds",
    "departure_delay_seconds",
    "actual_arrival",
    "actual_departure",
]


# ── Dimensions ───────────────────────────────────────────────────────────────


def dim_stops(stg_stops: DataFrame, versions: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """M1: latest attributes per stop across all versions (J2 + W1)."""
    s = join_manifest_by_prefix(stg_stops, versions, manifest)
    return latest_by_aggregate(
        s, ["stop_id"], ["downloaded_at", "version", "stop_name", "stop_lat", "stop_lon"]
    ).select("stop_id", "stop_name", "stop_lat", "stop_lon")


def dim_routes(stg_routes: DataFrame, versions: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """M2: latest attributes per route across all versions (J2 + W1)."""
    r = join_manifest_by_prefix(stg_routes, versions, manifest)
    return latest_by_aggregate(
        r, ["route_id"], ["downloaded_at", "version", "route_short_name", "route_type"]
    ).select("route_id", "route_short_name", "route_type")


def dim_trips(stg_trips: DataFrame, stg_routes: DataFrame) -> DataFrame:
    """M3: every (version, trip) with its route name (J3, inner)."""
    r = stg_routes.select("route_id", "version", "route_short_name")
    return stg_trips.join(r, ["route_id", "version"]).select(
        "version", "trip_id", "route_id", "service_id", "direction_id", "route_short_name"
    )


# ── Fact ─────────────────────────────────────────────────────────────────────

_OBS_COLUMNS = [
    "service_date",
    "trip_id",
    "route_id",
    "direction_id",
    "stop_sequence",
    "stop_id",
    "vehicle_id",
    "vehicle_label",
    "arrival_delay",
    "departure_delay",
    "feed_timestamp",
    "entity_id",
]


def _observations(stg_trip_updates: DataFrame) -> DataFrame:
    return stg_trip_updates.where(F.col("service_date").isNotNull()).select(*_OBS_COLUMNS)


def rank_observation_versions(stg_trip_updates: DataFrame, versions: DataFrame) -> DataFrame:
    """M4a (literal): every observation x covering version, ranked per event
    by newest poll, then newest download."""
    joined = attach_versions(_observations(stg_trip_updates), version_days(versions))
    order = ["feed_timestamp", "downloaded_at", "gtfs_version"] + OBS_ORDER[1:]
    return rank_latest(joined, EVENT_KEY, order)


def latest_observation(stg_trip_updates: DataFrame, versions: DataFrame) -> DataFrame:
    """The newest observation per event with its resolved version.

    Observations are reduced first; the covering version depends on the date
    alone, so the day's newest version is attached to the survivors only."""
    newest = latest_by_window(_observations(stg_trip_updates), EVENT_KEY, OBS_ORDER)
    return attach_versions(newest, newest_version_per_day(versions))


def _with_schedule(deduped: DataFrame, stg_stop_times: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Delays present -> schedule join -> wall-clock timestamps.

    ``carry``: further columns of ``deduped`` that each row keeps."""
    d = deduped.where(F.col("arrival_delay").isNotNull() | F.col("departure_delay").isNotNull())
    st = stg_stop_times.select(
        F.col("version").alias("gtfs_version"),
        "trip_id",
        F.col("stop_sequence").cast("bigint").alias("stop_sequence"),
        "arrival_interval",
        "departure_interval",
    )
    j = d.join(st, ["trip_id", "stop_sequence", "gtfs_version"])
    midnight = service_midnight("service_date")
    sched_arr = midnight + F.col("arrival_interval")
    sched_dep = midnight + F.col("departure_interval")
    return j.select(
        "service_date",
        "trip_id",
        "route_id",
        "direction_id",
        "stop_sequence",
        "stop_id",
        "vehicle_id",
        "vehicle_label",
        "gtfs_version",
        sched_arr.alias("scheduled_arrival"),
        sched_dep.alias("scheduled_departure"),
        F.col("arrival_delay").alias("arrival_delay_seconds"),
        F.col("departure_delay").alias("departure_delay_seconds"),
        (sched_arr + seconds_interval("arrival_delay")).alias("actual_arrival"),
        (sched_dep + seconds_interval("departure_delay")).alias("actual_departure"),
        *carry,
    )


def fct_stop_events(
    stg_trip_updates: DataFrame, versions: DataFrame, stg_stop_times: DataFrame
) -> DataFrame:
    """M4: the fact, dedup-first form (default)."""
    return _with_schedule(latest_observation(stg_trip_updates, versions), stg_stop_times)


def fct_range(
    stg_trip_updates: DataFrame, versions: DataFrame, stg_stop_times: DataFrame
) -> DataFrame:
    """M4, literal form: range join, rank over the multiplied rows, rn = 1."""
    ranked = rank_observation_versions(stg_trip_updates, versions)
    return _with_schedule(ranked.where(F.col("rn") == 1).drop("rn"), stg_stop_times)

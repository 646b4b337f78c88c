"""Staging projections (P1-P8): typed, renamed views over raw tables.

Pure column expressions -- Catalyst inlines them into every consumer, prunes
unused columns at the Parquet scan and pushes the status predicate of
``stg_trip_updates`` into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.dates import epoch_to_timestamp, parse_yyyymmdd
from headway.functions.gtfs_time import gtfs_time_seconds, gtfs_time_to_interval

SCHEDULED = 0  # schedule_relationship value of a normally served stop

# ``strict=True`` (default) keeps ANSI semantics: malformed text in a typed
# column raises, as the reference engine does.  ``strict=False`` turns it
# into NULL (try_cast / try_to_date) for feeds known to carry junk.


def _cast(col: str, to: str, strict: bool):
    return F.col(col).cast(to) if strict else F.col(col).try_cast(to)


def stg_gtfs_versions(versions: DataFrame) -> DataFrame:
    """Manifest passthrough."""
    return versions.select("version", "downloaded_at", "valid_from", "valid_to")


def stg_stops(stops: DataFrame, strict: bool = True) -> DataFrame:
    """Coordinates as DOUBLE."""
    return stops.select(
        "version",
        "stop_id",
        "stop_name",
        _cast("stop_lat", "double", strict).alias("stop_lat"),
        _cast("stop_lon", "double", strict).alias("stop_lon"),
    )


def stg_routes(routes: DataFrame, strict: bool = True) -> DataFrame:
    """``route_type`` as INT."""
    return routes.select(
        "version", "route_id", "route_short_name", _cast("route_type", "int", strict).alias("route_type")
    )


def stg_trips(trips: DataFrame, strict: bool = True) -> DataFrame:
    """``direction_id`` as INT."""
    return trips.select(
        "version",
        "route_id",
        "service_id",
        "trip_id",
        _cast("direction_id", "int", strict).alias("direction_id"),
    )


def stg_stop_times(stop_times: DataFrame, as_seconds: bool = False, strict: bool = True) -> DataFrame:
    """Sequence as INT, raw time strings kept, offsets from service-day
    midnight derived (intervals, or BIGINT seconds with ``as_seconds``)."""
    conv, suffix = (gtfs_time_seconds, "_secs") if as_seconds else (gtfs_time_to_interval, "_interval")
    return stop_times.select(
        "version",
        "trip_id",
        _cast("stop_sequence", "int", strict).alias("stop_sequence"),
        "stop_id",
        F.col("arrival_time").alias("arrival_time_str"),
        F.col("departure_time").alias("departure_time_str"),
        conv("arrival_time", strict).alias("arrival" + suffix),
        conv("departure_time", strict).alias("departure" + suffix),
    )


def stg_calendar_dates(calendar_dates: DataFrame, strict: bool = True) -> DataFrame:
    """P5: ``YYYYMMDD`` to DATE (malformed dates raise), type as INT."""
    date = F.to_date("date", "yyyyMMdd") if strict else F.try_to_date(F.col("date"), "yyyyMMdd")
    return calendar_dates.select(
        "version",
        "service_id",
        date.alias("service_date"),
        _cast("exception_type", "int", strict).alias("exception_type"),
    )


def stg_trip_updates(trip_updates: DataFrame, strict: bool = True) -> DataFrame:
    """Renamed observation columns plus service date, SCHEDULED only.

    The status filter runs before any dedup: when the newest poll marks a
    stop SKIPPED, the last SCHEDULED poll of that stop still wins.
    """
    return trip_updates.where(F.col("schedule_relationship") == SCHEDULED).select(
        "feed_timestamp",
        epoch_to_timestamp("feed_timestamp").alias("feed_ts"),
        "entity_id",
        "trip_id",
        "route_id",
        "direction_id",
        "start_date",
        parse_yyyymmdd("start_date", strict).alias("service_date"),
        "start_time",
        "vehicle_id",
        "vehicle_label",
        "stop_sequence",
        "stop_id",
        "schedule_relationship",
        "arrival_delay",
        F.col("arrival_time").alias("arrival_epoch"),
        "departure_delay",
        F.col("departure_time").alias("departure_epoch"),
    )


def stg_vehicle_positions(vehicle_positions: DataFrame, strict: bool = True) -> DataFrame:
    """Positions with service date and two zoned timestamps."""
    return vehicle_positions.select(
        "feed_timestamp",
        epoch_to_timestamp("feed_timestamp").alias("feed_ts"),
        "entity_id",
        "trip_id",
        "route_id",
        "direction_id",
        "start_date",
        parse_yyyymmdd("start_date", strict).alias("service_date"),
        "start_time",
        "vehicle_id",
        "vehicle_label",
        "latitude",
        "longitude",
        "bearing",
        "speed",
        "current_stop_sequence",
        "stop_id",
        "current_status",
        F.col("timestamp").alias("position_epoch"),
        epoch_to_timestamp("timestamp").alias("position_ts"),
    )

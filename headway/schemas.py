"""Explicit schemas for every raw table, partition columns included.

Raw tables are always read with these schemas: partition-type inference
turns hex version prefixes such as ``012345678901`` or ``12e3...`` into
numbers and silently loses rows, and schema inference over millions of
files is a driver-side cost we never want to pay.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, F = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.FloatType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The table and column names below are fixed values: they must equal those of
# stored landing zones.

# Version manifest: one row per ingested schedule archive.
VERSIONS = _struct(
    ("version", S),
    ("downloaded_at", S),
    ("valid_from", S),
    ("valid_to", S),
)

# Static schedule tables.  Every CSV column lands as a string; typing
# happens in staging.  ``version`` is the 12-character directory partition.
STATIC_TABLES = ("stops", "routes", "trips", "stop_times", "calendar_dates")

STATIC_COLUMNS: dict[str, tuple[str, ...]] = {
    "stops": ("stop_id", "stop_name", "stop_lat", "stop_lon"),
    "routes": ("route_id", "route_short_name", "route_type"),
    "trips": ("route_id", "service_id", "trip_id", "direction_id"),
    "stop_times": ("trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"),
    "calendar_dates": ("service_id", "date", "exception_type"),
}


def static_schema(table: str) -> T.StructType:
    """All-string schema of one static table plus the ``version`` partition."""
    return _struct(*[(c, S) for c in STATIC_COLUMNS[table]], ("version", S))


# Realtime observations, one row per stop update per poll.
TRIP_UPDATES = _struct(
    ("feed_timestamp", L),
    ("entity_id", S),
    ("trip_id", S),
    ("route_id", S),
    ("direction_id", I),
    ("start_date", S),
    ("start_time", S),
    ("vehicle_id", S),
    ("vehicle_label", S),
    ("stop_sequence", L),
    ("stop_id", S),
    ("arrival_delay", I),
    ("arrival_time", L),
    ("departure_delay", I),
    ("departure_time", L),
    ("schedule_relationship", I),
)

# Realtime vehicle positions, one row per vehicle per poll.
VEHICLE_POSITIONS = _struct(
    ("feed_timestamp", L),
    ("entity_id", S),
    ("trip_id", S),
    ("route_id", S),
    ("direction_id", I),
    ("start_date", S),
    ("start_time", S),
    ("vehicle_id", S),
    ("vehicle_label", S),
    ("latitude", D),
    ("longitude", D),
    ("bearing", F),
    ("speed", F),
    ("current_stop_sequence", L),
    ("stop_id", S),
    ("current_status", I),
    ("timestamp", L),
)

# Hive partitions of the realtime landing zone: UTC poll date and hour, and
# the poll key itself so that rerunning one poll replaces exactly that poll.
REALTIME_PARTITIONS = _struct(("date", T.DateType()), ("hour", I), ("poll", S))


def with_partitions(schema: T.StructType, partitions: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + list(partitions.fields))


TRIP_UPDATES_LANDED = with_partitions(TRIP_UPDATES, REALTIME_PARTITIONS)
VEHICLE_POSITIONS_LANDED = with_partitions(VEHICLE_POSITIONS, REALTIME_PARTITIONS)


# Nested realtime feed messages (the decoded form of one poll), following the
# public GTFS-Realtime message layout.  A missing sub-message is a NULL struct.
_TRIP = _struct(
    ("trip_id", S),
    ("route_id", S),
    ("direction_id", I),
    ("start_date", S),
    ("start_time", S),
)
_VEHICLE_DESC = _struct(("id", S), ("label", S))
_EVENT = _struct(("delay", I), ("time", L))
_STOP_TIME_UPDATE = _struct(
    ("stop_sequence", L),
    ("stop_id", S),
    ("arrival", _EVENT),
    ("departure", _EVENT),
    ("schedule_relationship", I),
)
_TRIP_UPDATE = _struct(
    ("trip", _TRIP),
    ("vehicle", _VEHICLE_DESC),
    ("stop_time_update", T.ArrayType(_STOP_TIME_UPDATE, True)),
    ("timestamp", L),
)
_POSITION = _struct(("latitude", D), ("longitude", D), ("bearing", F), ("speed", F))
_VEHICLE_POSITION = _struct(
    ("trip", _TRIP),
    ("vehicle", _VEHICLE_DESC),
    ("position", _POSITION),
    ("current_stop_sequence", L),
    ("stop_id", S),
    ("current_status", I),
    ("timestamp", L),
)
FEED_ENTITY = _struct(("id", S), ("trip_update", _TRIP_UPDATE), ("vehicle", _VEHICLE_POSITION))
FEED_MESSAGE = _struct(
    ("header", _struct(("gtfs_realtime_version", S), ("timestamp", L))),
    ("entity", T.ArrayType(FEED_ENTITY, True)),
)

# Archive landing: one row per archive file (binaryFile source).
ARCHIVE_ROWS = _struct(("version", S), ("table_name", S), ("row", T.MapType(S, S, True)))

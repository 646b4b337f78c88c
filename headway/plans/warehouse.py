"""End-to-end warehouse build (lifecycle E2) and the analytic queries.

``Warehouse`` wires raw tables through staging into the marts lazily: every
attribute is a DataFrame.  Small lookup tables (the manifest, versions per day)
are materialised and measured when a mart that needs them is planned; all else
waits for an action or a write.  Marts are materialised with ``write_marts`` (full rebuild, overwrite) and read
back by the analytic queries, as a dashboard would.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from headway.operators import analytics, marts, staging, versions
from headway.sources.readers import RawTables  # or any object with the same attributes

# Model names.
MART_TABLES = ("dim_stops", "dim_routes", "dim_trips", "fct_stop_events")


@dataclass
class Warehouse:
    raw: RawTables  # duck-typed: DerivedTables works too
    fact_form: str = "resolved"  # or "range" for the literal range-join form
    strict: bool = True  # False: malformed text becomes NULL instead of raising

    # ── staging ──────────────────────────────────────────────────────────────
    @cached_property
    def stg_gtfs_versions(self) -> DataFrame:
        return staging.stg_gtfs_versions(self.raw.versions)

    @cached_property
    def stg_stops(self) -> DataFrame:
        return staging.stg_stops(self.raw.stops, strict=self.strict)

    @cached_property
    def stg_routes(self) -> DataFrame:
        return staging.stg_routes(self.raw.routes, strict=self.strict)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return staging.stg_trips(self.raw.trips, strict=self.strict)

    @cached_property
    def stg_stop_times(self) -> DataFrame:
        return staging.stg_stop_times(self.raw.stop_times, strict=self.strict)

    @cached_property
    def stg_calendar_dates(self) -> DataFrame:
        return staging.stg_calendar_dates(self.raw.calendar_dates, strict=self.strict)

    @cached_property
    def stg_trip_updates(self) -> DataFrame:
        return staging.stg_trip_updates(self.raw.trip_updates, strict=self.strict)

    @cached_property
    def stg_vehicle_positions(self) -> DataFrame:
        return staging.stg_vehicle_positions(self.raw.vehicle_positions, strict=self.strict)

    # ── marts ────────────────────────────────────────────────────────────────
    @cached_property
    def manifest_by_prefix(self) -> DataFrame:
        """The size-checked manifest, materialised once for both dimensions."""
        return versions.manifest_by_prefix(self.stg_gtfs_versions)

    @cached_property
    def dim_stops(self) -> DataFrame:
        return marts.dim_stops(self.stg_stops, self.stg_gtfs_versions, self.manifest_by_prefix)

    @cached_property
    def dim_routes(self) -> DataFrame:
        return marts.dim_routes(self.stg_routes, self.stg_gtfs_versions, self.manifest_by_prefix)

    @cached_property
    def dim_trips(self) -> DataFrame:
        return marts.dim_trips(self.stg_trips, self.stg_routes)

    @cached_property
    def fct_stop_events(self) -> DataFrame:
        build = marts.fct_range if self.fact_form == "range" else marts.fct_stop_events
        return build(self.stg_trip_updates, self.stg_gtfs_versions, self.stg_stop_times)

    def mart(self, name: str) -> DataFrame:
        return getattr(self, name)


@dataclass
class Marts:
    """The four marts as DataFrames (built, or read back from storage)."""

    dim_stops: DataFrame
    dim_routes: DataFrame
    dim_trips: DataFrame
    fct_stop_events: DataFrame

    @classmethod
    def of(cls, wh: Warehouse) -> Marts:
        return cls(wh.dim_stops, wh.dim_routes, wh.dim_trips, wh.fct_stop_events)

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> Marts:
        return cls(*[spark.read.parquet(f"{root.rstrip('/')}/{t}") for t in MART_TABLES])

    # ── analytic queries (E3) ────────────────────────────────────────────────
    def punctuality_by_route(self) -> DataFrame:
        return analytics.punctuality_by_route(self.fct_stop_events, self.dim_routes)

    def punctuality_by_hour(self) -> DataFrame:
        return analytics.punctuality_by_hour(self.fct_stop_events)

    def punctuality_by_stop(self) -> DataFrame:
        return analytics.punctuality_by_stop(self.fct_stop_events, self.dim_stops)

    def delay_distribution(self) -> DataFrame:
        return analytics.delay_distribution(self.fct_stop_events)

    def total_stop_events(self) -> DataFrame:
        return analytics.total_stop_events(self.fct_stop_events)


def write_marts(wh: Warehouse, root: str, tables: tuple[str, ...] = MART_TABLES) -> dict[str, str]:
    """K4: materialise the marts as a full rebuild (overwrite), one
    directory per table; returns table -> path."""
    out = {}
    for t in tables:
        path = f"{root.rstrip('/')}/{t}"
        wh.mart(t).write.mode("overwrite").parquet(path)
        out[t] = path
    return out

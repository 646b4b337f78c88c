"""Schedule-version operators.

A schedule version is identified by the SHA-256 of its archive; tables are
keyed by its 12-character prefix.  Its validity window is the inclusive
range of ``calendar_dates`` dates.  Several versions can cover one day; the
most recently downloaded wins (``downloaded_at`` compared as text).

The observation-to-version match is a range join (service_date between
valid_from and valid_to).  Instead of a nested-loop join over every
observation and version, windows are expanded to the days they cover --
a table bounded by the number of calendar days in the manifest -- and
matched with an equi-join on ``service_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.dates import parse_yyyymmdd
from headway.operators.dedup import latest_by_aggregate
from headway.operators.joins import broadcast_bounded

PREFIX_LEN = 12


def content_hash(content: Column | str) -> Column:
    """Hex SHA-256 of the archive bytes."""
    c = F.col(content) if isinstance(content, str) else content
    return F.sha2(c, 256)


def version_prefix(version: Column | str) -> Column:
    """``left(version, 12)``."""
    c = F.col(version) if isinstance(version, str) else version
    return F.substring(c, 1, PREFIX_LEN)


def unseen_versions(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archives whose full hash is not in the manifest yet.

    Duplicates inside one batch collapse first; the manifest (one row per
    archive ever ingested) is broadcast after its size is checked.
    """
    known = broadcast_bounded(manifest.select("version").distinct())
    return candidates.dropDuplicates(["version"]).join(known, "version", "left_anti")


def validity_windows(calendar_dates: DataFrame) -> DataFrame:
    """min/max ``date`` string per version (exception type ignored)."""
    return calendar_dates.groupBy("version").agg(
        F.min("date").alias("valid_from"), F.max("date").alias("valid_to")
    )


def manifest_windows(versions: DataFrame) -> DataFrame:
    """Manifest rows with prefix and parsed window; an empty bound is NULL."""
    return versions.select(
        version_prefix("version").alias("gtfs_version"),
        "downloaded_at",
        parse_yyyymmdd("valid_from").alias("valid_from_date"),
        parse_yyyymmdd("valid_to").alias("valid_to_date"),
    )


def version_days(versions: DataFrame) -> DataFrame:
    """Every (service_date, version) pair of the range join J1.

    A version with a NULL bound or an inverted window covers no day, exactly
    as ``d >= from and d <= to`` would evaluate.
    """
    w = manifest_windows(versions).where(
        F.col("valid_from_date").isNotNull()
        & F.col("valid_to_date").isNotNull()
        & (F.col("valid_from_date") <= F.col("valid_to_date"))
    )
    return w.select(
        F.explode(F.sequence("valid_from_date", "valid_to_date")).alias("service_date"),
        "gtfs_version",
        "downloaded_at",
    )


def newest_version_per_day(versions: DataFrame) -> DataFrame:
    """(service_date, gtfs_version): the newest download covering each day."""
    return latest_by_aggregate(
        version_days(versions), ["service_date"], ["downloaded_at", "gtfs_version"]
    ).select("service_date", "gtfs_version")


def attach_versions(df: DataFrame, day_versions: DataFrame) -> DataFrame:
    """Equi-join on ``service_date`` against a size-checked broadcast table.

    Observations whose date no version covers are dropped (inner join)."""
    return df.join(broadcast_bounded(day_versions), "service_date")


def manifest_by_prefix(versions: DataFrame) -> DataFrame:
    """(12-char version, downloaded_at), materialised and size-checked for
    broadcast; build once and share between joins."""
    return broadcast_bounded(versions.select(version_prefix("version").alias("version"), "downloaded_at"))


def join_manifest_by_prefix(df: DataFrame, versions: DataFrame, bounded: DataFrame | None = None) -> DataFrame:
    """Attach ``downloaded_at`` by ``left(manifest.version, 12) = version``.
    ``bounded`` is a ready ``manifest_by_prefix`` result to reuse."""
    return df.join(bounded if bounded is not None else manifest_by_prefix(versions), "version")

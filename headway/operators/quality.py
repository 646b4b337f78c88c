"""Freshness and data-quality checks.

Every check is a lazy DataFrame: freshness gives one status row per check,
data tests give one summary row per tested column (failures counted by a
single aggregate pass), and the row-level variants return the failing rows.
The thin ``check_*`` wrappers collect the one-row status and raise, for
schedulers that want an exception.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.dates import epoch_to_utc_wall, local_hour, parse_iso_instant

# Local time zone of the service, quiet hours (no service,
# no realtime alarm), and the freshness thresholds.
LOCAL_TZ = "Europe/Rome"
QUIET_HOURS = (0, 1, 2, 3, 4)
RT_MAX_AGE = dt.timedelta(minutes=10)
STATIC_MAX_AGE = dt.timedelta(days=14)

# Plausible arrival-delay range for the bounds canary, seconds.
DELAY_LOWER_SEC = -600
DELAY_UPPER_SEC = 3600


class StaleDataError(Exception):
    """A freshness check that a scheduler should treat as failed."""


def _micros(now: dt.datetime) -> int:
    """Microseconds since the epoch of an instant that states its zone."""
    if now.tzinfo is None:
        raise ValueError("a check time needs a time zone")
    return (now - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def _check_times(checked_at: Sequence[dt.datetime]) -> Column:
    return F.explode(F.array(*[F.lit(_micros(t)).cast("bigint") for t in checked_at])).alias("now_micros")


def _seconds(micros: Column) -> Column:
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


# ── Freshness ────────────────────────────────────────────────────────────────


def latest_rt_feed_timestamp(rt: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Q1/O3: max ``feed_timestamp`` of the newest poll partition.

    ``max(struct(date, hour, poll, feed_timestamp))`` orders by the poll
    first, so its last field is the newest poll's maximum: one pass, partial
    aggregation (one row per task), no join.  ``since`` restricts the scan to
    ``date >= since`` by static partition pruning; with the feed's
    ``newest_date`` it is one day's scan.  One row; NULL when there is no data."""
    if since is not None:
        rt = rt.where(F.col("date") >= F.lit(since))
    newest = F.max(F.struct("date", "hour", "poll", "feed_timestamp"))
    return rt.agg(newest.alias("p")).select(F.col("p.feed_timestamp").alias("latest_feed_timestamp"))


def newest_date(rt: DataFrame) -> dt.date | None:
    """The newest ``date`` that holds rows, of any age.

    Only partition values and row counts are read (no data column), so the cost
    follows the number of files, not their size."""
    return rt.agg(F.max("date")).first()[0]


def rt_freshness_status(
    rt: DataFrame,
    feed: str,
    checked_at: Sequence[dt.datetime],
    max_age: dt.timedelta = RT_MAX_AGE,
    tz: str = LOCAL_TZ,
    quiet_hours: Iterable[int] = QUIET_HOURS,
    since: dt.date | None = None,
) -> DataFrame:
    """Q3: one status row per check time: quiet / no_data / fresh / stale.

    Quiet hours are checked first on the local wall clock; missing data only
    warns (status ``no_data``); stale means age strictly above ``max_age``."""
    x = latest_rt_feed_timestamp(rt, since).select("latest_feed_timestamp", _check_times(checked_at))
    now = _seconds(F.col("now_micros"))
    age = now - F.col("latest_feed_timestamp")
    exact_age = F.col("now_micros") - F.col("latest_feed_timestamp") * F.lit(1_000_000)
    hour = local_hour(now, tz)
    limit = int(max_age.total_seconds())
    status = (
        F.when(hour.isin(list(quiet_hours)), F.lit("quiet"))
        .when(F.col("latest_feed_timestamp").isNull(), F.lit("no_data"))
        .when(exact_age > max_age // dt.timedelta(microseconds=1), F.lit("stale"))
        .otherwise(F.lit("fresh"))
    )
    return x.select(
        F.lit(feed).alias("feed"),
        epoch_to_utc_wall(now).alias("checked_at"),
        hour.alias("local_hour"),
        "latest_feed_timestamp",
        age.alias("age_seconds"),
        F.lit(limit).cast("bigint").alias("max_age_seconds"),
        status.alias("status"),
    )


def latest_static_download(versions: DataFrame) -> DataFrame:
    """Q2/A10: newest ``downloaded_at`` as microseconds since the epoch; text
    without an offset counts as UTC.  One row; NULL when the manifest is empty."""
    ts = parse_iso_instant("downloaded_at")
    return versions.agg(F.max(F.unix_micros(ts)).alias("latest_download_micros"))


def static_freshness_status(
    versions: DataFrame,
    checked_at: Sequence[dt.datetime],
    max_age: dt.timedelta = STATIC_MAX_AGE,
) -> DataFrame:
    """Q4: one status row per check time: missing / fresh / stale."""
    x = latest_static_download(versions).select("latest_download_micros", _check_times(checked_at))
    exact_age = F.col("now_micros") - F.col("latest_download_micros")
    now, latest, age = _seconds(F.col("now_micros")), _seconds(F.col("latest_download_micros")), _seconds(exact_age)
    limit = int(max_age.total_seconds())
    status = (
        F.when(F.col("latest_download_micros").isNull(), F.lit("missing"))
        .when(exact_age > max_age // dt.timedelta(microseconds=1), F.lit("stale"))
        .otherwise(F.lit("fresh"))
    )
    return x.select(
        epoch_to_utc_wall(now).alias("checked_at"),
        epoch_to_utc_wall(latest).alias("latest_download"),
        age.alias("age_seconds"),
        F.lit(limit).cast("bigint").alias("max_age_seconds"),
        status.alias("status"),
    )


def check_rt_freshness(
    rt: DataFrame,
    feed: str,
    now: dt.datetime,
    max_age: dt.timedelta = RT_MAX_AGE,
    tz: str = LOCAL_TZ,
    quiet_hours: Iterable[int] = QUIET_HOURS,
) -> str:
    """Raise ``StaleDataError`` when stale; return the status otherwise.

    In quiet hours nothing is read.  Else the newest date that holds rows is
    found from the partitions, whatever its age, and only that date is read."""
    if now.astimezone(ZoneInfo(tz)).hour in set(quiet_hours):
        return "quiet"
    row = rt_freshness_status(rt, feed, [now], max_age, tz, quiet_hours, since=newest_date(rt)).first()
    if row["status"] == "stale":
        raise StaleDataError(
            f"no {feed} for {row['age_seconds']} s (allowed: {row['max_age_seconds']} s); newest message: {row['latest_feed_timestamp']}"
        )
    return row["status"]


def check_static_freshness(
    versions: DataFrame, now: dt.datetime, max_age: dt.timedelta = STATIC_MAX_AGE
) -> str:
    """Raise when the manifest is empty (missing) or stale."""
    row = static_freshness_status(versions, [now], max_age).first()
    if row["status"] == "missing":
        raise StaleDataError("the manifest lists no schedule")
    if row["status"] == "stale":
        days = dt.timedelta(seconds=row["age_seconds"]).days
        raise StaleDataError(f"newest schedule is {days} days old (allowed: {max_age.days}), downloaded {row['latest_download']}")
    return row["status"]


# ── Data tests ───────────────────────────────────────────────────────────────


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Q5 rows: non-null values occurring more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Q6 rows: records with a NULL in ``column``."""
    return df.where(F.col(column).isNull())


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Q7/J6 rows: child records whose non-null key is absent from the parent."""
    keys = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def delay_bound_violations(
    fct: DataFrame, lower: int = DELAY_LOWER_SEC, upper: int = DELAY_UPPER_SEC
) -> DataFrame:
    """Q8 rows: stop events whose arrival delay is outside [lower, upper]."""
    d = F.col("arrival_delay_seconds")
    return fct.where((d < lower) | (d > upper)).select(
        "service_date", "trip_id", "stop_id", "arrival_delay_seconds"
    )


def _status(failures: Column, severity: str) -> Column:
    return F.when(failures > 0, F.lit("fail" if severity == "error" else "warn")).otherwise(F.lit("pass"))


def summarize(model: str, test: str, column: str, failing: DataFrame, severity: str = "error") -> DataFrame:
    """One summary row (model, test, column_name, failures, status)."""
    n = F.count(F.lit(1)).alias("failures")
    return failing.agg(n).select(
        F.lit(model).alias("model"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        "failures",
        _status(F.col("failures"), severity).alias("status"),
    )


def not_null_summary(model: str, df: DataFrame, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """Q6 summary: all columns of one model counted in one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "failures")
    return long.select(
        F.lit(model).alias("model"),
        F.lit("not_null").alias("test"),
        "column_name",
        "failures",
        _status(F.col("failures"), severity).alias("status"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def mart_readiness(spark, frames: dict[str, DataFrame | None]) -> DataFrame:
    """Q9: per mart ``missing`` (no table), ``empty`` or ``ready`` with rows."""
    rows = []
    for name, df in frames.items():
        if df is None:
            rows.append(
                spark.range(1).select(
                    F.lit(name).alias("table_name"),
                    F.lit("missing").alias("status"),
                    F.lit(None).cast("bigint").alias("n_rows"),
                )
            )
            continue
        rows.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                F.when(F.col("n_rows") == 0, F.lit("empty")).otherwise(F.lit("ready")).alias("status"),
                "n_rows",
            )
        )
    return union_all(rows)


def read_mart_or_none(spark, path: str) -> DataFrame | None:
    """A stored mart, or None when it was never written."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def readiness_of_root(spark, root: str, tables: Sequence[str]) -> DataFrame:
    """Q9 over a stored warehouse: each mart directory under ``root``."""
    return mart_readiness(spark, {t: read_mart_or_none(spark, f"{root.rstrip('/')}/{t}") for t in tables})


# The declared tests of the marts (model -> columns).
UNIQUE_TESTS = {"dim_stops": ["stop_id"], "dim_routes": ["route_id"]}
NOT_NULL_TESTS = {
    "dim_stops": ["stop_id", "stop_name"],
    "dim_routes": ["route_id", "route_short_name"],
    "dim_trips": ["trip_id", "route_id"],
    "fct_stop_events": ["trip_id", "stop_id", "service_date", "scheduled_arrival"],
}
# (child model, column, parent model, parent column)
RELATIONSHIP_TESTS = [
    ("dim_trips", "route_id", "dim_routes", "route_id"),
    ("fct_stop_events", "stop_id", "dim_stops", "stop_id"),
]


def unique_summary(marts) -> DataFrame:
    return union_all(
        [
            summarize(m, "unique", c, unique_failures(getattr(marts, m), c))
            for m, cols in UNIQUE_TESTS.items()
            for c in cols
        ]
    )


def not_null_summaries(marts) -> DataFrame:
    return union_all([not_null_summary(m, getattr(marts, m), cols) for m, cols in NOT_NULL_TESTS.items()])


def relationship_summary(marts) -> DataFrame:
    return union_all(
        [
            summarize(child, "relationships", col, relationship_failures(getattr(marts, child), col, getattr(marts, parent), field))
            for child, col, parent, field in RELATIONSHIP_TESTS
        ]
    )


def data_test_summary(marts, bounds_severity: str = "error") -> DataFrame:
    """Every declared test of the marts, one summary row each: unique,
    not_null, relationships, and the delay-bounds canary (whose severity is
    a parameter: ``error`` fails, ``warn`` only warns)."""
    bounds = summarize(
        "fct_stop_events",
        "delay_bounds",
        "arrival_delay_seconds",
        delay_bound_violations(marts.fct_stop_events),
        severity=bounds_severity,
    )
    return union_all([unique_summary(marts), not_null_summaries(marts), relationship_summary(marts), bounds])

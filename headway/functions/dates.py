"""Date and timestamp expressions.

Wall-clock schedule times are TIMESTAMP_NTZ: adding an interval to a naive
midnight never shifts across a daylight-saving change.  Epoch instants are
converted either to zoned TIMESTAMPs (``timestamp_seconds``) or, for output
that must not depend on the session time zone, to UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ_VALUE = "1970-01-01 00:00:00"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_yyyymmdd(col: Column | str, strict: bool = True) -> Column:
    """``YYYYMMDD`` string to DATE; empty string is NULL.

    ``strict`` keeps ANSI behaviour (malformed dates raise, as the reference
    engine does); ``strict=False`` turns them into NULL instead.
    """
    c = F.nullif(_c(col), F.lit(""))
    if strict:
        return F.to_date(c, "yyyyMMdd")
    return F.try_to_date(c, "yyyyMMdd")


def ymd(col: Column | str) -> Column:
    """DATE to ``YYYYMMDD`` string."""
    return F.date_format(_c(col), "yyyyMMdd")


def service_midnight(col: Column | str) -> Column:
    """Naive midnight of a service date (F4): ``date::timestamp``."""
    return _c(col).cast("timestamp_ntz")


def epoch_to_timestamp(col: Column | str) -> Column:
    """Epoch seconds to a zoned TIMESTAMP (F8, ``to_timestamp(epoch)``)."""
    return F.timestamp_seconds(_c(col))


def epoch_to_utc_wall(col: Column | str) -> Column:
    """Epoch seconds to UTC wall clock as TIMESTAMP_NTZ, session-zone free."""
    return F.lit(_EPOCH_NTZ_VALUE).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), _c(col)
    )


def epoch_utc_date(col: Column | str) -> Column:
    """UTC calendar date of an epoch second, independent of the session zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(_c(col) / 86400).cast("int"))


def epoch_utc_hour(col: Column | str) -> Column:
    """UTC hour of day of an epoch second."""
    return F.floor(F.pmod(_c(col), F.lit(86400)) / 3600).cast("int")


def poll_key(col: Column | str) -> Column:
    """Poll identifier ``yyyyMMdd'T'HHmmss`` of an epoch second in UTC (F16),
    built from date/hour pieces so the session zone never leaks in."""
    e = _c(col)
    secs = F.pmod(e, F.lit(86400))
    return F.concat(
        F.date_format(epoch_utc_date(e), "yyyyMMdd"),
        F.lit("T"),
        F.lpad(F.floor(secs / 3600).cast("string"), 2, "0"),
        F.lpad(F.floor(F.pmod(secs, F.lit(3600)) / 60).cast("string"), 2, "0"),
        F.lpad(F.pmod(secs, F.lit(60)).cast("string"), 2, "0"),
    )


def truncate_epoch(col: Column | str, seconds: int = 60) -> Column:
    """Epoch second truncated to a multiple of ``seconds`` (poll granularity)."""
    return (F.floor(_c(col) / seconds) * seconds).cast("bigint")


def local_wall(epoch_seconds: Column | str, tz: str) -> Column:
    """Wall clock of ``tz`` at an epoch second, as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), epoch_to_utc_wall(epoch_seconds))


def local_hour(epoch_seconds: Column | str, tz: str) -> Column:
    """Hour of day on the wall clock of ``tz`` at an epoch second."""
    return F.hour(local_wall(epoch_seconds, tz))


def parse_iso_instant(col: Column | str) -> Column:
    """ISO-8601 text to an instant; text without an offset is taken as UTC."""
    c = _c(col)
    has_zone = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(has_zone, F.to_timestamp(c)).otherwise(F.to_timestamp(F.concat(c, F.lit("Z"))))

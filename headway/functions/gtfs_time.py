"""GTFS ``H:MM:SS`` schedule times.

GTFS times count from noon-minus-12h of the service day and may exceed 24
hours for trips that run past midnight (``25:30:00``), so they can never be
parsed as a time of day.  They are split on ``:`` and turned into a
day-time interval (or total seconds).  All expressions are built-ins and
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(col: Column, n: int, strict: bool = True) -> Column:
    # split_part with an ANSI cast: junk raises, as in the reference engine;
    # strict=False turns junk into NULL instead.
    p = F.split_part(col, F.lit(":"), F.lit(n))
    return p.cast("int") if strict else p.try_cast("int")


def gtfs_time_seconds(col: Column | str, strict: bool = True) -> Column:
    """Seconds after service-day midnight, as BIGINT (``25:15:00`` -> 90900)."""
    c = F.col(col) if isinstance(col, str) else col
    h, m, s = (_part(c, i, strict) for i in (1, 2, 3))
    return (h.cast("bigint") * 3600 + m.cast("bigint") * 60 + s).cast("bigint")


def gtfs_time_to_interval(col: Column | str, strict: bool = True) -> Column:
    """Day-time interval after service-day midnight; hours >= 24 allowed."""
    c = F.col(col) if isinstance(col, str) else col
    return F.make_dt_interval(F.lit(0), *(_part(c, i, strict) for i in (1, 2, 3)))


def seconds_interval(col: Column | str) -> Column:
    """``n * interval 1 second`` for an integer column; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c)

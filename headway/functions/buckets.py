"""Punctuality classification.

Fixed values that must equal the reference's for identical results: the
on-time band and the seven histogram buckets (label, order, upper bound).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# On time means a delay in [-60, 300] seconds, both ends included.
ON_TIME_MIN_SEC = -60
ON_TIME_MAX_SEC = 300

# Histogram buckets, half-open upper bounds in seconds, in order.
DELAY_BUCKETS = (
    ("< -1 min (early)", 1, -60),
    ("-1 to 0 min", 2, 0),
    ("0 to 1 min", 3, 60),
    ("1 to 3 min", 4, 180),
    ("3 to 5 min", 5, 300),
    ("5 to 10 min", 6, 600),
    ("> 10 min (late)", 7, None),
)


def is_on_time(delay: Column) -> Column:
    return delay.between(ON_TIME_MIN_SEC, ON_TIME_MAX_SEC)


def _chain(delay: Column, pick) -> Column:
    expr = None
    for label, order, upper in DELAY_BUCKETS:
        value = F.lit(pick(label, order))
        if upper is None:
            return expr.otherwise(value)
        cond = delay < upper
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def delay_bucket_label(delay: Column) -> Column:
    return _chain(delay, lambda label, order: label)


def delay_bucket_order(delay: Column) -> Column:
    return _chain(delay, lambda label, order: order)

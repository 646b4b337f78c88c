"""Keep-the-newest-row operators.

Two physical forms of the same rule "one row per key, the greatest by an
ordered list of columns (all DESC NULLS LAST)":

* ``latest_by_aggregate``: ``groupBy(keys).agg(max(struct(order..., rest...)))``.
  The aggregate combines map-side, so a key holding a third of all rows is
  reduced inside every input partition before the shuffle, and no task ever
  sees more than one row per key per upstream partition.
* ``latest_by_window``: ``row_number() over (partition by keys order by ...)``
  filtered to 1 -- the literal form; Spark inserts a partial
  ``WindowGroupLimit`` before the exchange.

The fact uses the window form (measured faster: no per-row struct
building); dimensions use the aggregate form.  Both are sort-based and
skew-safe.  Struct comparison is field by field with NULL lowest, so ``max`` of the
struct equals the first row under ``ORDER BY c1 DESC NULLS LAST, c2 DESC
NULLS LAST, ...``.  Ties on every ordering column can only differ in
columns outside the output, so both forms return identical rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_aggregate(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """One row per ``keys``: the max of ``order`` (then ``carry``) columns."""
    fields = [c for c in list(order) + list(carry) if c not in keys]
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in fields])


def order_desc(order: Sequence[str]) -> list:
    return [F.col(c).desc_nulls_last() for c in order]


def rank_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """Add ``row_number()`` over ``keys`` ordered by ``order`` DESC NULLS LAST."""
    w = Window.partitionBy(*keys).orderBy(*order_desc(order))
    return df.withColumn(name, F.row_number().over(w))


def latest_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return rank_latest(df, keys, order, "_rn").where(F.col("_rn") == 1).drop("_rn")

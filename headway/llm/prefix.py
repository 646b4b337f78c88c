"""Distributed prefix sums: native DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.store import materialise


def global_prefix(df: DataFrame, order: list[str], measure: str, name: str) -> DataFrame:
    """Add ``before`` (sum of ``measure`` over all earlier rows) and ``rank`` (from 0).

    Rows are range-partitioned by ``order`` and written with their partition
    number; per-partition totals give each partition its offset, and a running
    sum inside the partition gives the rest.  Nothing but the totals (one row
    a partition) meets in one task.  Rows that agree in every column of
    ``order`` are told apart by their place in the scan, so that a third of all
    rows being equal still spreads over partitions.
    """
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*order, "_tie").withColumn("_part", F.spark_partition_id())
    table = materialise(ranged, f"{name}-ranged")
    within = W.partitionBy("_part").orderBy(*order, "_tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = table.groupBy("_part").agg(F.sum(measure).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        _or_zero(F.sum("_sum").over(earlier)).alias("_sum0"),
        _or_zero(F.sum("_rows").over(earlier)).alias("_rows0"),
    )
    # one row a range partition: the number of shuffle partitions bounds it
    return (
        table.withColumn("_run", F.sum(measure).over(within))
        .withColumn("_n", F.row_number().over(within))
        .join(F.broadcast(offsets), "_part")
        .withColumn("before", F.col("_sum0") + F.col("_run") - F.col(measure))
        .withColumn("rank", F.col("_rows0") + F.col("_n") - 1)
        .drop("_part", "_run", "_n", "_sum0", "_rows0", "_tie")
    )


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("long"))

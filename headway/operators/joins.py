"""Join helpers: broadcast only what is proven small.

A side is broadcast only after it has been materialised in the shared
checkpoint directory and its bytes summed; beyond the bound it is returned
without a hint, and Spark plans a shuffle join whose skewed partitions AQE
splits.  Either way the rows are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import checkpoint_root

#: Bytes of a side that every executor may hold: text lengths plus 16 per field.
BROADCAST_BYTES = 64 << 20


def text_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, estimated from the values themselves."""
    size = F.lit(0)
    for c in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16
    return int(df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0])


def broadcast_bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Materialise ``df`` (cutting its lineage), measure it, and mark it for
    broadcast when it holds at most ``max_bytes``."""
    checkpoint_root(df.sparkSession)
    small = df.checkpoint(eager=True)
    return F.broadcast(small) if text_bytes(small) <= max_bytes else small

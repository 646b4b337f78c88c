"""Contiguous shards of equal bytes by global prefix sums (native).

Documents are put in one global order, a distributed prefix sum of their sizes
gives each the byte offset at which it starts, and the offsets are cut at equal
targets.  The order is by the text's MD5 and then doc_id: it is random with
regard to source and language, and equal texts are neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.prefix import global_prefix
from headway.llm.store import materialise

#: Bytes that a shard spends on a row besides its text.
ROW_BYTES = 8


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, null as none."""
    return F.octet_length(F.coalesce(text, F.lit("")))


def byte_prefix_shards(
    docs: DataFrame, shards: int = 24, row_bytes: int = ROW_BYTES, whole_share: float = 0.005
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A row lies in the shard in which the middle of its bytes falls, so a shard
    misses its target by at most the two rows at its ends.  A group of equal
    texts that a cut would split stays whole, on the side of its middle, if it
    is at most ``whole_share`` of a shard; larger groups are split at the cut.

    Null text: no bytes.  Null doc_id: kept, first among equal texts.  Repeated
    rows each get a slot.  An empty table gives an empty result.  Other columns
    of ``docs`` are not looked at.
    """
    sized = docs.select(
        "doc_id",
        (text_bytes(F.col("text")) + row_bytes).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("text_key"),
    )
    rows = materialise(global_prefix(sized, ["text_key", "doc_id"], "size", "shards"), "shards-prefix")
    total = rows.agg(F.sum("size")).first()[0] or 1  # one number
    cut = rows.withColumn(
        "shard",
        F.least(F.expr(f"((2 * before + size) * {shards}L) div {2 * total}L"), F.lit(shards - 1).cast("long")),
    )
    # The first and last row of each shard (at most one row a shard each).
    ends = cut.groupBy("shard").agg(
        F.min_by("text_key", "rank").alias("first_key"), F.max_by("text_key", "rank").alias("last_key")
    )
    later = ends.select((F.col("shard") - 1).alias("shard"), F.col("first_key").alias("text_key"))
    split = ends.join(F.broadcast(later), "shard").where("last_key = text_key").select("text_key").distinct()
    groups = (
        cut.join(F.broadcast(split), "text_key", "left_semi")
        .groupBy("text_key")
        .agg(
            F.min("before").alias("start"),
            F.max(F.col("before") + F.col("size")).alias("end"),
        )
        .where(f"(end - start) * {shards}D <= {total * whole_share}D")
        .select("text_key", F.expr(f"((start + end) * {shards}L) div {2 * total}L").alias("whole"))
    )  # at most one group a cut
    placed = (
        cut.join(F.broadcast(groups), "text_key", "left")
        .withColumn("shard", F.coalesce("whole", "shard"))
        .select("doc_id", "size", "text_crc32", "shard", "rank")
    )
    starts = placed.groupBy("shard").agg(F.min("rank").alias("start_rank"))  # one row a shard
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - F.col("start_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

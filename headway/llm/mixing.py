"""Mix sources to target weights by budgets over distributed prefix sums.

Each source gets a budget of words.  Its documents are put in a hash-random
order, a distributed prefix sum gives the words before each, and the order is
cut exactly at the budget; a budget above the source's size repeats it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.prefix import global_prefix

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: float) -> DataFrame:
    """Target of each source; ``sizes`` has one row a source (source, source_size).

    Sources share ``share`` times all words by weight; none gets more than
    ``limit`` times its size, and the excess goes to the others by weight until
    none is above.  With sources ordered by size over weight, the stopped ones
    come first, so one pass of running sums finds the level of the rest.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    everywhere = W.partitionBy()
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    weighted = (
        sizes.withColumn("_n", F.row_number().over(by_name) - 1)
        .withColumn("weight", pick)
        .withColumn("_cap", F.col("source_size") * F.lit(float(limit)))
        .withColumn("source_start", F.sum("source_size").over(by_name.rowsBetween(W.unboundedPreceding, 0)) - F.col("source_size"))
    )
    fill = W.orderBy(F.col("_cap") / F.col("weight"), F.col("_n"))
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    levels = (
        weighted.withColumn("_rank", F.row_number().over(fill))
        .withColumn("_left", F.sum("source_size").over(everywhere) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_weights"))
        .withColumn("_free", F.col("_cap") > F.col("_level") * F.col("weight"))
        .withColumn("_level", F.min_by("_level", F.when(F.col("_free"), F.col("_rank"))).over(everywhere))
    )
    target = F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_level") * F.col("weight")))
    return levels.select("source", "source_size", "source_start", "weight", target.alias("target"))


def budget_prefix_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = 17,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, and the columns ``keep``.

    ``taken``: words that the mix takes from the document, repeats counted:
    whole epochs of the source, plus, of the last epoch, what lies before the
    budget in the source's random order.  The order is by the MD5 of seed and
    doc_id, so reruns agree.  A document at the cut is taken in part.

    Null text: 0 words.  Null source: a source of its own, last in order.  Null
    doc_id and repeated rows are documents like others.  Empty table: empty
    result.  Other columns are not looked at.
    """
    sized = docs.select(
        "doc_id",
        "source",
        *keep,
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("draw"),
    ).withColumn("_none", F.col("source").isNull())
    rows = global_prefix(sized, ["_none", "source", "draw", "doc_id", "size"], "size", "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, limit).withColumnRenamed("source", "_source")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("CAST(round(target) AS BIGINT) div source_size")).otherwise(F.lit(0).cast("long"))
    part = F.least(
        F.greatest(budget - F.col("_epochs") * F.col("source_size") - (F.col("before") - F.col("source_start")), F.lit(0).cast("long")),
        F.col("size"),
    )
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_epochs", epochs)
        .withColumn("taken", F.col("_epochs") * F.col("size") + part)
        .select("doc_id", "source", *keep, "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as its words are taken.

    The document at a source's cut is kept whole if at least half of it is
    taken.  Documents without words hold nothing to take and go.  Rows equal in
    doc_id, source and text share their copies evenly.
    """
    own = docs.withColumn("_text_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    copies = (
        budget_prefix_mix(own, keep=("_text_key",))
        .where("size > 0")
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("_text_key").alias("_key"))
        .agg(F.round(F.avg(F.round(F.col("taken") / F.col("size")))).cast("int").alias("_copies"))
        .where("_copies > 0")
    )
    same = (
        (F.col("_text_key") == F.col("_key"))
        & F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("source").eqNullSafe(F.col("_source"))
    )
    return (
        own.join(copies, same)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*docs.columns)
    )


ORACLE_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER earlier, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW earlier AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT arg_min(level, place) FILTER (WHERE cap > level * weight) AS height FROM filled
), targets AS (
  SELECT source, source_size, CASE WHEN height IS NULL THEN cap ELSE least(cap, height * weight) END AS target
  FROM filled, water
), running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size END * size
         + least(greatest(CASE WHEN source_size = 0 THEN budget ELSE budget % source_size END - before, 0), size) AS BIGINT) AS taken
FROM running
"""

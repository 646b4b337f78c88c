"""Ingest of schedule archives member by member.

``ingest_members`` takes a folder of zip files.  Archives are hashed as streams;
their tables are read by as many tasks as there are members.  Known versions and
repeats within the folder are skipped, broken archives are reported and left out
whole, archives that were replaced between the two reads wait for the next run.
The manifest comes last, as in ``plans.ingest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.joins import broadcast_bounded
from headway.operators.versions import validity_windows
from headway.plans import sinks
from headway.plans.ingest import refuse_prefix_collisions
from headway.session import checkpoint_root, scratch_path
from headway.sources import archives as arc
from headway.sources.archive_members import read_index, read_members
from headway.sources.readers import read_manifest


def ingest_members(spark: SparkSession, folder: str, root: str, downloaded_at: str | None = None) -> DataFrame:
    """One row per archive file: path, version, status, valid_from, valid_to, skipped_tables, error.

    status: ``ingested``, ``skipped`` (in the manifest already, or the same bytes
    as an earlier file of the folder), ``changed`` (replaced during the run) or
    ``broken``.  ``downloaded_at`` overrides the files' times."""
    checkpoint_root(spark)
    manifest = read_manifest(spark, root)
    index = read_index(spark, folder).checkpoint(eager=True)
    sound = index.where("error IS NULL")
    first = sound.groupBy("version").agg(F.min_by(F.struct("path", "size", "modified"), "path").alias("f")).select("version", "f.*")
    known = broadcast_bounded(manifest.select("version").distinct())
    fresh = first.join(known, "version", "left_anti").checkpoint(eager=True)
    refuse_prefix_collisions(fresh, manifest)

    # Rows are stored once: tables, windows, report and manifest all derive from them.
    store = scratch_path(spark, "members")
    wanted = broadcast_bounded(fresh)
    read_members(spark, folder).join(wanted, ["path", "size", "modified"]).select("version", "table_name", "row", "error").write.parquet(store)
    rows = spark.read.parquet(store)
    broken = rows.where("error IS NOT NULL").groupBy("version").agg(F.min("error").alias("member_error")).checkpoint(eager=True)
    whole = rows.join(broadcast_bounded(broken.select("version")), "version", "left_anti")
    for table in schemas.STATIC_TABLES:
        sinks.write_static(arc.table_rows(whole, table), root, table)

    opened = whole.where("table_name = ''").select("version").distinct()
    calendar = whole.where("table_name = 'calendar_dates'").select("version", F.col("row")["date"].alias("date"))
    stamp = F.col("modified") if downloaded_at is None else F.lit(downloaded_at)
    ingested = (
        fresh.join(opened, "version")
        .join(validity_windows(calendar), "version", "left")
        .select("version", stamp.alias("downloaded_at"), F.coalesce("valid_from", F.lit("")).alias("valid_from"), F.coalesce("valid_to", F.lit("")).alias("valid_to"))
        .checkpoint(eager=True)
    )
    sinks.append_manifest(ingested, root)

    lacking = arc.skipped_tables(opened, whole).groupBy("version").agg(F.sort_array(F.collect_list("table_name")).alias("skipped_tables"))
    done = fresh.select("path", F.lit(True).alias("taken"))
    report = index.join(done, "path", "left").join(ingested.drop("downloaded_at").withColumn("kept", F.lit(True)), "version", "left")
    report = report.join(lacking, "version", "left").join(broken, "version", "left")
    taken = F.coalesce("taken", F.lit(False))
    status = (
        F.when(F.col("error").isNotNull() | (taken & F.col("member_error").isNotNull()), "broken")
        .when(~taken, "skipped")
        .when(F.col("kept").isNull(), "changed")
        .otherwise("ingested")
    )
    landed = status == "ingested"
    return report.select(
        "path",
        "version",
        status.alias("status"),
        F.when(landed, F.col("valid_from")).alias("valid_from"),
        F.when(landed, F.col("valid_to")).alias("valid_to"),
        F.when(landed, F.coalesce("skipped_tables", F.array().cast("array<string>"))).alias("skipped_tables"),
        F.coalesce("error", "member_error").alias("error"),
    ).checkpoint(eager=True)

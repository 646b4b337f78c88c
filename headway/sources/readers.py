"""Landing-zone readers.

Layout under a root URI (local path, HDFS, object store -- any Hadoop FS):

    gtfs_static/versions/                     manifest, one row per archive
    gtfs_static/<table>/version=<12 hex>/     five static tables
    trip_updates/date=YYYY-MM-DD/hour=HH/poll=<yyyyMMddTHHmmss>/
    vehicle_positions/date=.../hour=.../poll=.../

The manifest is deliberately not ``_``-prefixed: Spark treats such paths
as hidden and silently reads nothing.  Every read passes an explicit
schema including partition columns and a ``basePath`` so partitions are
discovered without type inference; a missing source yields an empty
DataFrame rather than an error, so a fresh deployment builds empty marts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from headway import schemas

MANIFEST_DIR = "gtfs_static/versions"


def source_root(root: str | None) -> str:
    """Resolve the landing root; fail loudly when unset."""
    if root is None or not str(root).strip():
        raise ValueError("source root is not set: pass the landing-zone URI explicitly")
    return str(root).rstrip("/")


def read_source(
    spark: SparkSession,
    root: str,
    path: str,
    schema: T.StructType,
    base: str | None = None,
) -> DataFrame:
    """Read Parquet under ``root/path`` (a glob is allowed) with an explicit
    schema; ``base`` names the directory where partition discovery starts (S1).
    Missing paths give an empty DataFrame of the same schema."""
    root = source_root(root)
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", f"{root}/{base}")
    try:
        return reader.parquet(f"{root}/{path}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Version manifest, empty when none was written yet."""
    return read_source(spark, root, MANIFEST_DIR, schemas.VERSIONS)


def read_static(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One static table over all versions, ``version`` as STRING."""
    base = f"gtfs_static/{table}"
    return read_source(spark, root, base, schemas.static_schema(table), base=base)


def read_static_all_columns(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One static table with every column that any version landed (as text)."""
    path = f"{source_root(root)}/gtfs_static/{table}"
    merged = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
    names = [c for c in merged.columns if c != "version"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "version"]])
    return read_source(spark, root, f"gtfs_static/{table}", schema, base=f"gtfs_static/{table}")


def read_static_reference_layout(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Static table stored one file per version directory
    (``gtfs_static/version=*/<table>.parquet``), as some landing zones do."""
    return read_source(
        spark,
        root,
        f"gtfs_static/version=*/{table}.parquet",
        schemas.static_schema(table),
        base="gtfs_static",
    )


def read_realtime(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """All polls of one realtime feed with ``date``, ``hour``, ``poll``.

    Filters on ``date``/``hour`` prune whole directories before any file is
    opened."""
    schema = {
        "trip_updates": schemas.TRIP_UPDATES_LANDED,
        "vehicle_positions": schemas.VEHICLE_POSITIONS_LANDED,
    }[feed]
    return read_source(spark, root, feed, schema, base=feed)


@dataclass(frozen=True)
class RawTables:
    """The eight raw inputs of the warehouse build."""

    versions: DataFrame
    stops: DataFrame
    routes: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    calendar_dates: DataFrame
    trip_updates: DataFrame
    vehicle_positions: DataFrame


def load_landing(spark: SparkSession, root: str, since=None) -> RawTables:
    """All raw tables of a landing zone.

    ``since`` (a date) restricts both realtime feeds to ``date >= since``:
    a partition filter, so older polls are never listed for reading.  Use it
    with the streaming/incremental marts to rebuild only recent dates."""
    rt = {f: read_realtime(spark, root, f) for f in ("trip_updates", "vehicle_positions")}
    if since is not None:
        from pyspark.sql import functions as F

        rt = {f: df.where(F.col("date") >= F.lit(since)) for f, df in rt.items()}
    return RawTables(
        versions=read_manifest(spark, root),
        stops=read_static(spark, root, "stops"),
        routes=read_static(spark, root, "routes"),
        trips=read_static(spark, root, "trips"),
        stop_times=read_static(spark, root, "stop_times"),
        calendar_dates=read_static(spark, root, "calendar_dates"),
        trip_updates=rt["trip_updates"],
        vehicle_positions=rt["vehicle_positions"],
    )

"""Landing zones of another layout, read as ours.

Some zones keep one file a poll, one file a table and version, and the manifest
in one file that Spark takes for hidden:

    gtfs_static/_versions.parquet
    gtfs_static/version=<12 hex>/<table>.parquet
    <feed>/date=YYYY-MM-DD/hour=HH/<yyyyMMddTHHmmss>.parquet

``load_zone`` reads such a zone, one of our layout, or one that holds both (after
a move, say) into the same raw tables: the poll key comes from the file's name,
columns that a file lacks are null, further ones are left out, unsigned numbers
are read as our types.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas
from headway.functions.dates import poll_key
from headway.plans.files import Files
from headway.session import scratch_path
from headway.sources.readers import MANIFEST_DIR, RawTables, read_source, read_static_reference_layout, source_root

# Names in the other layout.
MANIFEST_FILE = "gtfs_static/_versions.parquet"
POLL_STAMP = r"(\d{8}T\d{6})"

_FEEDS = {"trip_updates": schemas.TRIP_UPDATES, "vehicle_positions": schemas.VEHICLE_POSITIONS}


class Zone:
    """What a landing zone holds in either layout."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, source_root(root), Files(spark)

    @cached_property
    def layout(self) -> dict[str, str]:
        """Per source: ``ours``, ``files``, ``both`` or ``none``; found from a few names, no data is read."""
        static = self.files.names(f"{self.root}/gtfs_static")
        found = {"versions": self._which("versions" in static, self.files.exists(f"{self.root}/{MANIFEST_FILE}"))}
        by_version = any(n.startswith("version=") for n in static)
        for table in schemas.STATIC_TABLES:
            found[table] = self._which(table in static, by_version)
        for feed in _FEEDS:
            found[feed] = self._feed_layout(feed)
        return found

    @staticmethod
    def _which(ours: bool, files: bool) -> str:
        return "both" if ours and files else "ours" if ours else "files" if files else "none"

    def _feed_layout(self, feed: str) -> str:
        """By the first and the last hour that hold anything: a zone changes its layout at one time."""
        base, ours, files = f"{self.root}/{feed}", False, False
        dates = [n for n in self.files.names(base) if n.startswith("date=")]
        for date in dict.fromkeys([*dates[:1], *dates[-1:]]):
            hours = [n for n in self.files.names(f"{base}/{date}") if n.startswith("hour=")]
            for hour in dict.fromkeys([*hours[:1], *hours[-1:]]):
                names = self.files.names(f"{base}/{date}/{hour}")
                ours |= any(n.startswith("poll=") for n in names)
                files |= any(n.endswith(".parquet") for n in names)
        return self._which(ours, files)

    def _parts(self, source: str, ours, files, schema: T.StructType) -> DataFrame:
        kind = self.layout[source]
        parts = ([ours()] if kind in ("ours", "both") else []) + ([files()] if kind in ("files", "both") else [])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def versions(self) -> DataFrame:
        """The manifest; a version that both layouts list counts once."""

        def from_file() -> DataFrame:
            seen = f"{scratch_path(self.spark, 'manifest')}/versions.parquet"
            self.files.copy(f"{self.root}/{MANIFEST_FILE}", seen)  # one row an archive
            return self.spark.read.schema(schemas.VERSIONS).parquet(seen)

        both = self._parts("versions", lambda: read_source(self.spark, self.root, MANIFEST_DIR, schemas.VERSIONS), from_file, schemas.VERSIONS)
        return both.dropDuplicates(["version"]) if self.layout["versions"] == "both" else both

    def static(self, table: str) -> DataFrame:
        """One static table; a version that both layouts hold is taken from ours."""
        base, schema = f"gtfs_static/{table}", schemas.static_schema(table)
        here = lambda: read_source(self.spark, self.root, base, schema, base=base)

        def there() -> DataFrame:
            rows = read_static_reference_layout(self.spark, self.root, table)
            if self.layout[table] == "both":
                have = [n.removeprefix("version=") for n in self.files.names(f"{self.root}/{base}")]
                rows = rows.where(~F.col("version").isin(have))
            return rows

        return self._parts(table, here, there, schema)

    def realtime(self, feed: str) -> DataFrame:
        """One feed with ``date``, ``hour``, ``poll``; a poll that both layouts hold is taken from ours."""
        flat = _FEEDS[feed]
        landed = schemas.with_partitions(flat, schemas.REALTIME_PARTITIONS)
        here = lambda: read_source(self.spark, self.root, f"{feed}/date=*/hour=*/poll=*", landed, base=feed)

        def there() -> DataFrame:
            no_poll = T.StructType([f for f in landed.fields if f.name != "poll"])
            rows = read_source(self.spark, self.root, f"{feed}/date=*/hour=*/*.parquet", no_poll, base=feed)
            stamp = F.regexp_extract(F.col("_metadata.file_name"), POLL_STAMP, 1)
            rows = rows.withColumn("poll", F.when(stamp != "", stamp).otherwise(poll_key("feed_timestamp"))).select(*landed.fieldNames())
            if self.layout[feed] == "both":
                rows = rows.join(here().select("date", "hour", "poll").distinct(), ["date", "hour", "poll"], "left_anti").select(*landed.fieldNames())
            return rows

        return self._parts(feed, here, there, landed)


def load_zone(spark: SparkSession, root: str) -> RawTables:
    """All raw tables of a landing zone, whichever layout its parts have."""
    zone = Zone(spark, root)
    tables = {t: zone.static(t) for t in schemas.STATIC_TABLES}
    feeds = {f: zone.realtime(f) for f in _FEEDS}
    return RawTables(versions=zone.versions(), **tables, **feeds)

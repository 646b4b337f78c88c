"""The newest polls of a feed, found by walking its partitions from the end (O3, Q1).

``date=/hour=/poll=`` folders sort by time, so the newest files are reached by
listing one folder a level, last name first.  Nothing else of the history is
listed or read: the cost of a freshness check does not grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from headway import schemas
from headway.plans.files import Files
from headway.sources.readers import source_root


def _key(name: str) -> tuple:
    """Partition folders in order of their values: hours as numbers, all else as text."""
    value = name.partition("=")[2] or name
    return (1, int(value), "") if value.isdigit() else (0, 0, value)


def newest_first(files: Files, path: str, depth: int) -> Iterator[str]:
    """Folders ``depth`` levels below ``path``, newest first; levels are listed only as they are reached."""
    if depth == 0:
        yield path
        return
    for name in sorted((n for n in files.names(path) if "=" in n), key=_key, reverse=True):
        yield from newest_first(files, f"{path}/{name}", depth - 1)


def newest_poll_files(spark: SparkSession, root: str, feed: str) -> list[str]:
    """The data files of the newest poll that has any, one file unless the poll is large.

    Polls without a data file (an interrupted write) are passed over."""
    files = Files(spark)
    for poll in newest_first(files, f"{source_root(root)}/{feed}", len(schemas.REALTIME_PARTITIONS.fields)):
        found = [n for n in files.names(poll) if n.endswith(".parquet")]
        if found:
            return [f"{poll}/{n}" for n in found]
    return []


def newest_poll(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """``feed_timestamp`` of the rows of the newest poll, with its partition columns; empty without data."""
    paths = newest_poll_files(spark, root, feed)
    names = schemas.REALTIME_PARTITIONS.fieldNames()
    schema = T.StructType([schemas.TRIP_UPDATES["feed_timestamp"], *schemas.REALTIME_PARTITIONS.fields])
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{source_root(root)}/{feed}").parquet(*paths)
    return rows.select("feed_timestamp", *names)

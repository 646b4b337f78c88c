"""Schedule archives: zip files of CSV tables.

Archives are read with the ``binaryFile`` source (one row per file, many
files read in parallel), hashed with ``sha2`` on the executors, and
unpacked by ``mapInArrow``: each task opens its archives, reads the five
known tables by exact root-level member name, decodes UTF-8 with an
optional byte-order mark, and streams rows out in bounded Arrow batches
as ``(version, table_name, row MAP<column, value>)``.  Per-table projection
then happens in Spark and keeps every column that a file has.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from functools import partial
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.functions.dates import epoch_to_utc_wall
from headway.operators.versions import content_hash

BATCH_ROWS = 10_000

_ROW_SCHEMA = pa.schema(
    [
        ("version", pa.string()),
        ("table_name", pa.string()),
        ("row", pa.map_(pa.string(), pa.string())),
    ]
)


def read_archives(spark: SparkSession, path_glob: str) -> DataFrame:
    """Archive bytes with their content hash (I1) as ``version``, and the
    time each file was stored as ``downloaded_at`` (ISO text, UTC)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path_glob)
    wall = epoch_to_utc_wall(F.unix_seconds("modificationTime"))
    return df.select(
        "path",
        "content",
        content_hash("content").alias("version"),
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss").alias("downloaded_at"),
    )


def _rows_of(version: str, content: bytes, most: int | None = None) -> Iterator[tuple[str, str, list]]:
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        names = set(zf.namelist())
        for table in schemas.STATIC_TABLES:
            member = f"{table}.txt"
            if member not in names:  # only root-level members count
                continue
            with zf.open(member) as fh:
                reader = csv.DictReader(io.TextIOWrapper(fh, encoding="utf-8-sig", newline=""))
                for rec in islice(reader, most):
                    yield version, table, [(k, v) for k, v in rec.items() if k is not None]


def _unpack_batches(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    buf: list[tuple[str, str, list]] = []
    for batch in batches:
        versions = batch.column("version").to_pylist()
        contents = batch.column("content").to_pylist()
        for version, content in zip(versions, contents, strict=True):
            buf.append((version, "", []))  # says that this archive was unpacked
            for row in _rows_of(version, content, most):
                buf.append(row)
                if len(buf) >= BATCH_ROWS:
                    yield _to_batch(buf)
                    buf = []
    if buf:
        yield _to_batch(buf)


def _to_batch(rows: list[tuple[str, str, list]]) -> pa.RecordBatch:
    v, t, r = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.string()), pa.array(t, pa.string()), pa.array(r, _ROW_SCHEMA.field("row").type)],
        schema=_ROW_SCHEMA,
    )


def unpack_archives(archives: DataFrame) -> DataFrame:
    """``(version, content)`` rows to ``(version, table_name, row)``, and
    one row of an empty ``table_name`` for each archive."""
    return archives.select("version", "content").mapInArrow(_unpack_batches, schemas.ARCHIVE_ROWS)


def first_rows(archives: DataFrame) -> DataFrame:
    """What ``unpack_archives`` gives, of each table of an archive its first row
    only: enough to know its columns, without inflating the rest."""
    return archives.select("version", "content").mapInArrow(partial(_unpack_batches, most=1), schemas.ARCHIVE_ROWS)


def table_rows(rows: DataFrame, table: str, prefix_len: int = 12, named_by: DataFrame | None = None) -> DataFrame:
    """Project one table's rows to string columns plus the 12-char ``version``
    partition key: the columns that staging reads (NULL where a file lacks
    them) and every other column that any of the files has.

    The files' columns are looked up in ``named_by`` (``first_rows`` of the same
    archives) or in all ``rows``, which are computed once more for it."""
    own = rows.where(F.col("table_name") == table)
    known = schemas.STATIC_COLUMNS[table]
    heads = own if named_by is None else named_by.where(F.col("table_name") == table)
    names = heads.select(F.explode(F.map_keys("row")).alias("c")).distinct().collect()  # the files' headers
    extra = sorted({r.c for r in names} - set(known) - {"version"})
    return own.select(
        *[F.col("row")[c].alias(c) for c in [*known, *extra]],
        F.substring("version", 1, prefix_len).alias("version"),
    )


def skipped_tables(archives: DataFrame, rows: DataFrame) -> DataFrame:
    """(version, table_name) expected but absent or empty in an archive."""
    expected = archives.select("version").distinct().select(
        "version", F.explode(F.array(*[F.lit(t) for t in schemas.STATIC_TABLES])).alias("table_name")
    )
    present = rows.where("table_name <> ''").select("version", "table_name").distinct()
    return expected.join(present, ["version", "table_name"], "left_anti")

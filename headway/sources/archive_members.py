"""Schedule archives as a Spark data source: a partition a member, or some small ones.

``archive_members`` reads the central directories of the zip files below a
folder and inflates each table file of each archive as a stream through range
reads: an archive is never held whole and its tables are read by different
tasks.  Small members share a task, so that tasks grow with the bytes and not
with the archives.  ``archive_index`` gives one row an archive: content hash (streamed), size, time, or what is wrong with it.  A
broken archive or member becomes a row with ``error`` set; the job goes on.

Files are opened through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from headway import schemas

CHUNK = 4 << 20
BATCH_ROWS = 10_000
#: Compressed bytes that one task reads, about, and what opening a member counts as.
TASK_BYTES = 16 << 20
OPEN_BYTES = 256 << 10
#: Tasks that a folder is dealt to before they are filled up.
LEAST_TASKS = 64

_MAP = pa.map_(pa.string(), pa.string())
MEMBERS = "path string, size bigint, modified string, table_name string, row map<string,string>, error string"
INDEX = "path string, size bigint, modified string, version string, error string"
_MEMBERS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.string()), ("table_name", pa.string()), ("row", _MAP), ("error", pa.string())])
_INDEX = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.string()), ("version", pa.string()), ("error", pa.string())])


@dataclass
class Archive(InputPartition):
    """One zip file, or one member of it, as it was when the read was planned."""

    path: str
    size: int
    modified: str
    table: str = ""
    error: str | None = None
    stored: int = 0  # compressed bytes to read


@dataclass
class Parts(InputPartition):
    """What one task reads."""

    parts: list[Archive]


def _dealt(parts: list[Archive]) -> list[Parts]:
    """Neighbours together until a task has its bytes; a large one stays alone."""
    limit = min(TASK_BYTES, sum(p.stored + OPEN_BYTES for p in parts) // LEAST_TASKS)
    tasks, filled = [], 0
    for p in parts:
        weight = p.stored + OPEN_BYTES
        if not tasks or filled + weight > limit:
            tasks.append(Parts([]))
            filled = 0
        tasks[-1].parts.append(p)
        filled += weight
    return tasks or [Parts([])]  # the folder may have no archive


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _listed(folder: str) -> list[Archive]:
    """The zip files directly below ``folder``, in order of their names."""
    where, base = _open(folder)
    found = where.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
    scheme = folder[: len(folder) - len(base)] if folder.endswith(base) else ""
    zips = sorted((f for f in found if f.is_file and f.base_name.endswith(".zip")), key=lambda f: f.path)
    return [Archive(scheme + f.path, f.size, _iso(f.mtime), stored=f.size) for f in zips]


def _iso(time: dt.datetime | None) -> str:
    return "" if time is None else time.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")


def _says(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def _members(archive: Archive) -> list[Archive]:
    """A part for each known table in the root of the archive, or one that tells why there is none."""
    where, path = _open(archive.path)
    try:
        with where.open_input_file(path) as body, zipfile.ZipFile(body) as z:
            sizes = {i.filename: i.compress_size for i in z.infolist()}
    except (zipfile.BadZipFile, OSError, ValueError) as problem:
        return [Archive(archive.path, archive.size, archive.modified, "", _says(problem))]
    tables = [t for t in schemas.STATIC_TABLES if f"{t}.txt" in sizes]
    # the empty table name says that the archive was opened
    return [Archive(archive.path, archive.size, archive.modified, t, stored=sizes.get(f"{t}.txt", 0)) for t in ["", *tables]]


class _MembersReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Parts]:
        return _dealt([m for a in _listed(self.folder) for m in _members(a)])

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            yield from self._member(part)

    def _member(self, part: Archive) -> Iterator[pa.RecordBatch]:
        head = (part.path, part.size, part.modified, part.table)
        if not part.table:
            yield _batch([(*head, [], part.error)])
            return
        where, path = _open(part.path)
        rows: list[tuple] = []
        try:
            with where.open_input_file(path) as body, zipfile.ZipFile(body) as z, z.open(f"{part.table}.txt") as member:
                for record in csv.DictReader(io.TextIOWrapper(member, encoding="utf-8-sig", newline="")):
                    rows.append((*head, [(k, v) for k, v in record.items() if k is not None], None))
                    if len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows = []
        except (zipfile.BadZipFile, OSError, ValueError, EOFError, csv.Error, KeyError) as problem:
            rows.append((*head, [], _says(problem)))
        except Exception as problem:  # zlib.error has no common base but Exception
            if type(problem).__module__ != "zlib":
                raise
            rows.append((*head, [], _says(problem)))
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _MEMBERS, strict=True)], schema=_MEMBERS)


class _IndexReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Parts]:
        return _dealt(_listed(self.folder))

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        rows = [self._hashed(part) for part in partition.parts]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _INDEX, strict=True)], schema=_INDEX)

    def _hashed(self, part: Archive) -> tuple:
        where, path = _open(part.path)
        digest, error = hashlib.sha256(), None
        try:
            with where.open_input_stream(path) as body:
                while chunk := body.read(CHUNK):
                    digest.update(chunk)
            with where.open_input_file(path) as body, zipfile.ZipFile(body):
                pass
        except (zipfile.BadZipFile, OSError, ValueError) as problem:
            error = _says(problem)
        return (part.path, part.size, part.modified, digest.hexdigest(), error)


class ArchiveMembers(DataSource):
    """``spark.read.format("archive_members").load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> DataSourceReader:
        return _MembersReader(self.options["path"])


class ArchiveIndex(DataSource):
    """``spark.read.format("archive_index").load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "archive_index"

    def schema(self) -> str:
        return INDEX

    def reader(self, schema) -> DataSourceReader:
        return _IndexReader(self.options["path"])


def read_members(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all table files: path, size, modified, table_name, row, error.

    Each archive also has one row of an empty ``table_name``, with ``error`` set
    if its directory cannot be read; a member that breaks off has an error row."""
    spark.dataSource.register(ArchiveMembers)
    return spark.read.format("archive_members").load(folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row an archive: path, size, modified, version (SHA-256 of its bytes), error."""
    spark.dataSource.register(ArchiveIndex)
    return spark.read.format("archive_index").load(folder)

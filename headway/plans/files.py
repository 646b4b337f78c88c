"""Names, renames and deletes on any Hadoop file system, as jobs' commits need them.

Only names pass through the driver; file contents are read and written by Spark
jobs, apart from pointer files of one line.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import shuffles_removed

class Files:
    """The file system operations of one session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names directly below ``path`` in order; none where it is absent.

        Names that start with ``_`` or ``.`` are not listed, as Spark hides them."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def copy(self, source: str, target: str) -> None:
        """Copy one small file."""
        (source_fs, s), (target_fs, t) = self._at(source), self._at(target)
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, s, target_fs, t, False, True, self._conf)

    def rename(self, source: str, target: str) -> None:
        """Move ``source`` to ``target``, which must not exist."""
        fs, t = self._at(target)
        if fs.exists(t):
            raise FileExistsError(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(self._at(source)[1], t):
            raise OSError(f"{source} could not be moved to {target}")

    def read_line(self, path: str) -> str | None:
        """The text of a small file, None where it is absent."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_line(self, path: str, text: str) -> None:
        """Put a small file in place whole: written beside it, then renamed over it."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        beside = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        choice = self._jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        choice[0] = options.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf).rename(beside, p, choice)

    def replace(self, source: str, target: str, depth: int) -> None:
        """Move the folders ``depth`` levels below ``source`` to the same places below ``target``.

        Those already there are replaced.  A folder that ``target`` lacks moves
        whole, so a level is only walked where both have it.  Depth 0: ``source``
        itself moves."""
        fs, to = self._at(target)
        if depth > 0 and fs.exists(to):
            for name in self.names(source):
                self.replace(f"{source}/{name}", f"{target}/{name}", depth - 1)
            return
        fs.delete(to, True)
        if not fs.rename(self._at(source)[1], to):
            raise OSError(f"{source} could not be moved to {target}")


def publish(df: DataFrame, root: str, name: str, partitions: tuple[str, ...] = ()) -> None:
    """Write ``df`` to ``root/name`` so that it appears whole or not at all.

    It is written to a hidden folder below ``root`` and renamed.  A name that
    exists already is left as it is: it was published by an earlier attempt."""
    files = Files(df.sparkSession)
    if files.exists(f"{root}/{name}"):
        return
    hidden = f"{root}/_writing-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    with shuffles_removed(df.sparkSession):
        (writer.partitionBy(*partitions) if partitions else writer).parquet(hidden)
    files.rename(hidden, f"{root}/{name}")


def _partitions(spark: SparkSession, root: str, tops: list[str], depth: int) -> DataFrame:
    """(top, rest) of the folders with files ``depth`` levels below ``root``, in its folders ``tops``.

    Spark lists the files; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{root}/{t}" for t in tops])
    below = F.slice(F.split("path", "/"), -depth - 1, depth)
    return files.select(below[0].alias("top"), F.array_join(F.slice(below, 2, depth), "/").alias("rest")).distinct()


_NULL = "__HIVE_DEFAULT_PARTITION__"
_END, _NONE = "\x01", "\x02"


def _folder(key: str, partitions: tuple[str, ...]) -> str:
    """The folder of the partition values in ``key``, escaped as Spark escapes them."""

    def text(value: str) -> str:
        if value in ("", _NONE):
            return _NULL
        return "".join(f"%{ord(c):02X}" if c < " " or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value)

    return "/".join(f"{name}={text(value)}" for name, value in zip(partitions, key.split(_END), strict=True))


def _writing(local: str, partitions: tuple[str, ...], token: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write each run of rows of one partition as one file, whole once it has its name.

    A task that runs again writes the same names again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{token}.snappy.parquet"
        attempt = f"{local}/_attempts/{task.taskAttemptId()}-{uuid.uuid4().hex}"
        os.makedirs(f"{local}/_attempts", exist_ok=True)
        at, file, files = None, None, 0

        def end():
            file.close()
            folder = f"{local}/{_folder(at, partitions)}"
            os.makedirs(folder, exist_ok=True)
            os.replace(attempt, f"{folder}/{name}")

        for batch in batches:
            keys = batch.column("_folder").to_numpy(zero_copy_only=False)
            rows = batch.drop_columns(["_folder"])
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if keys[lo] != at:
                    if file is not None:
                        end()
                    at, file, files = keys[lo], pq.ParquetWriter(attempt, rows.schema), files + 1
                file.write_batch(rows.slice(lo, hi - lo))
        if file is not None:
            end()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return run


def write_partitions(df: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    """Write ``df`` below the new folder ``path``, a folder for each of its partitions.

    Spark's writer starts a process for the permissions of every folder and file
    that it makes on a local file system, four a partition; there the tasks make
    the same files without it."""
    files = Files(df.sparkSession)
    fs, at = files._at(path)
    names = [c for c in df.columns if c not in partitions]
    if fs.getScheme() != "file" or not names:
        df.write.mode("error").partitionBy(*partitions).parquet(path)
        return
    local = fs.makeQualified(at).toUri().getPath()
    fs.mkdirs(at)
    key = F.concat_ws(_END, *(F.coalesce(F.col(c).cast("string"), F.lit(_NONE)) for c in partitions))
    rows = df.sortWithinPartitions(*partitions).select(*names, key.alias("_folder"))
    rows.mapInArrow(_writing(local, partitions, uuid.uuid4().hex), "files long").write.format("noop").mode("overwrite").save()
    files.delete(f"{path}/_attempts")


def replace_partitions(df: DataFrame, path: str, partitions: tuple[str, ...]) -> list[str]:
    """Write ``df`` below ``path``; partitions that it has rows of are replaced, all others stay.

    Returns the names of the first-level folders that it has rows of.

    Dynamic partition overwrite with whole folders moved: it does not make each
    partition's folders one after another on the driver.  A first-level folder
    moves whole if ``path`` lacks it or holds no partition there that ``df``
    lacks; only others are walked."""
    spark, files, depth = df.sparkSession, Files(df.sparkSession), len(partitions)
    hidden = f"{path}/_writing-{uuid.uuid4().hex}"
    try:
        with shuffles_removed(spark):
            write_partitions(df, hidden, partitions)
        there, names = set(files.names(path)), files.names(hidden)
        both = [name for name in names if name in there]
        mixed = set(both)
        if depth > 1 and len(both) > 1:
            stay = _partitions(spark, path, both, depth).join(_partitions(spark, hidden, both, depth), ["top", "rest"], "left_anti")
            mixed = {row[0] for row in stay.select("top").distinct().collect()}
        for name in names:
            files.replace(f"{hidden}/{name}", f"{path}/{name}", depth - 1 if name in mixed else 0)
        return names
    finally:
        files.delete(hidden)

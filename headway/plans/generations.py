"""Tables that change all at once: generation folders and one pointer file (K4, K6).

    <root>/<table>/generation=<g>/    a table as one commit wrote it
    <root>/_current                   the commit in force: table -> generation

A commit writes new generations beside the old ones and then replaces the
pointer, one small file, by a rename.  Readers follow the pointer once and so
see all tables of one commit, never a mix and never a half-written table; a
commit that fails leaves the pointer, and so every reader, as it was.  Old
generations stay for readers that hold them until ``reclaim``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.plans.files import Files
from headway.plans.warehouse import MART_TABLES, Marts, Warehouse


class Generations:
    """Tables below one root, committed together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def current(self) -> dict[str, str]:
        """Table -> generation of the commit in force; empty before the first."""
        line = self.files.read_line(f"{self.root}/_current")
        return json.loads(line) if line else {}

    def _path(self, table: str, generation: str) -> str:
        return f"{self.root}/{table}/generation={generation}"

    def commit(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], partitions: Mapping[str, tuple[str, ...]] | None = None) -> dict[str, int]:
        """Write ``tables`` and put them in force together; returns the rows written of each.

        Tables that are not named keep their generation.  One writer at a time:
        if another commit came in force meanwhile, nothing is put in force."""
        before, generation, rows = self.current(), uuid.uuid4().hex, {}
        for name, table in tables.items():
            df = table if isinstance(table, DataFrame) else table()
            seen = Observation(f"commit-{name}")
            writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error")
            parts = (partitions or {}).get(name, ())
            (writer.partitionBy(*parts) if parts else writer).parquet(self._path(name, generation))
            rows[name] = int(seen.get["rows"])
        if self.current() != before:
            raise RuntimeError(f"another commit was made below {self.root}; this one is not in force")
        self.files.write_line(f"{self.root}/_current", json.dumps({**before, **dict.fromkeys(tables, generation)}, sort_keys=True))
        return rows

    def read(self, *tables: str) -> list[DataFrame | None]:
        """The tables of one commit, None for those that it lacks."""
        now = self.current()
        return [self.spark.read.parquet(self._path(t, now[t])) if t in now else None for t in tables]

    def reclaim(self) -> int:
        """Delete generations that are not in force (old, or of failed commits); returns how many.

        Not to be run beside a commit or a reader of an older one."""
        now, count = self.current(), 0
        for table in self.files.names(self.root):
            for name in self.files.names(f"{self.root}/{table}"):
                if name.startswith("generation=") and name != f"generation={now.get(table)}":
                    self.files.delete(f"{self.root}/{table}/{name}")
                    count += 1
        return count


def commit_marts(wh: Warehouse, root: str, tables: tuple[str, ...] = MART_TABLES) -> dict[str, int]:
    """K4: build the marts and put all of them in force at once."""
    return Generations(wh.stg_gtfs_versions.sparkSession, root).commit({t: lambda t=t: wh.mart(t) for t in tables})


def read_marts(spark: SparkSession, root: str) -> Marts | None:
    """The marts of the commit in force; None before the first whole one."""
    found = Generations(spark, root).read(*MART_TABLES)
    return None if any(t is None for t in found) else Marts(*found)

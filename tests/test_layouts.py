"""Zones of another layout, of ours, and of both read alike."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from headway import schemas
from headway.plans.warehouse import Warehouse
from headway.sources.layouts import Zone, load_zone
from headway.sources.readers import load_landing
from tests.conftest import write_golden

UNSIGNED = {"direction_id": pa.uint8(), "stop_sequence": pa.uint32(), "schedule_relationship": pa.uint8(), "current_stop_sequence": pa.uint32(), "current_status": pa.uint8()}


def write_foreign(raw, root, feeds=("trip_updates", "vehicle_positions")):
    """The golden zone with one file a poll, a table version and the manifest; an extra column in some."""

    def put(path, rows, drop=()):
        table = rows.toArrow().drop_columns(list(drop))
        for c, t in UNSIGNED.items():
            if c in table.column_names and "trip_id" in table.column_names and "feed_timestamp" in table.column_names:
                table = table.set_column(table.column_names.index(c), c, table[c].cast(t))
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(table.append_column("extra", pa.array([1] * table.num_rows)), path)

    for feed in feeds:
        rows = getattr(raw, feed)
        for r in rows.select("date", "hour", "poll").distinct().collect():
            own = rows.where((rows.date == r.date) & (rows.hour == r.hour) & (rows.poll == r.poll))
            put(root / feed / f"date={r.date}" / f"hour={r.hour:02d}" / f"{r.poll}.parquet", own, ("date", "hour", "poll"))
    for name in schemas.STATIC_TABLES:
        rows = getattr(raw, name)
        for r in rows.select("version").distinct().collect():
            put(root / "gtfs_static" / f"version={r.version}" / f"{name}.parquet", rows.where(rows.version == r.version), ("version",))
    put(root / "gtfs_static" / "_versions.parquet", raw.versions)


def content(raw):
    return {name: sorted(map(str, getattr(raw, name).select(*sorted(getattr(raw, name).columns)).collect())) for name in raw.__dataclass_fields__}


@pytest.fixture(scope="module")
def ours(spark, golden_root):
    return content(load_landing(spark, golden_root))


def test_foreign_zone_equals_ours(spark, golden, ours, tmp_path):
    root = tmp_path / "zone"
    write_foreign(golden.raw, root)
    assert set(Zone(spark, str(root)).layout.values()) == {"files"}
    zone = load_zone(spark, str(root))
    assert content(zone) == ours
    assert Warehouse(zone).fct_stop_events.count() == 4


def test_our_layout_and_both(spark, golden, golden_root, ours, tmp_path):
    assert content(load_zone(spark, golden_root)) == ours
    root = tmp_path / "zone"
    write_golden(spark, str(root))
    write_foreign(golden.raw, root)
    assert set(Zone(spark, str(root)).layout.values()) == {"both"}
    assert content(load_zone(spark, str(root))) == ours  # nothing twice


def test_empty_zone_and_names_without_a_stamp(spark, golden, tmp_path):
    empty = load_zone(spark, str(tmp_path / "none"))
    assert all(getattr(empty, t).count() == 0 for t in empty.__dataclass_fields__)
    root = tmp_path / "zone"
    write_foreign(golden.raw, root, ("trip_updates",))
    for f in list((root / "trip_updates").rglob("*.parquet")):
        f.rename(f.with_name("part-0.parquet"))
    polls = {r.poll for r in Zone(spark, str(root)).realtime("trip_updates").collect()}
    assert polls == {"20310305T091100", "20310312T091500"}


def test_a_file_is_written_in_row_groups(spark, tmp_path, monkeypatch):
    """No task holds a whole group: a file of many rows gets as many row groups."""
    from pyspark.sql import functions as F

    from headway.plans import registry

    monkeypatch.setattr(registry, "_FOREIGN_ROWS", 10_000)
    rows = spark.range(45_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("delay"), F.lit("0a").alias("version"))
    one = spark.range(1).select("id", F.lit(None).cast("long").alias("delay"), F.lit(None).cast("string").alias("version"))
    write = registry._write_foreign(str(tmp_path), "version={version}/trips.parquet", {"delay": "uint32"})
    paths = [r.path for r in rows.unionByName(one).groupBy("version").applyInArrow(write, "path string").collect()]
    assert sorted(paths) == [f"{tmp_path}/version={v}/trips.parquet" for v in ("0a", "None")]
    file = pq.ParquetFile(tmp_path / "version=0a" / "trips.parquet")
    assert file.metadata.num_row_groups >= 4 and file.schema_arrow.names == ["id", "delay"] and file.schema_arrow.field("delay").type == pa.uint32()
    got = file.read()
    assert sorted(got["id"].to_pylist()) == list(range(45_000)) and got["delay"].null_count == 15_000

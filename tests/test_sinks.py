"""Idempotent writes, publishing and mirroring."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.functions.dates import poll_key
from headway.plans import sinks
from headway.plans.ingest import with_poll_partitions
from headway.sources.readers import read_manifest, read_realtime


def _polls(golden, ts):
    flat = golden.raw.trip_updates.select(*schemas.TRIP_UPDATES.fieldNames())
    return with_poll_partitions(flat.withColumn("feed_timestamp", F.lit(ts).cast("bigint")), ts)


def test_poll_key_is_deterministic(spark):
    ts = 1785421500  # 2026-07-30 14:25:00 UTC
    r = spark.range(1).select(poll_key(F.lit(ts)).alias("p")).first()
    assert r.p == "20260730T142500"
    df = with_poll_partitions(spark.range(1).select(F.lit(ts).cast("bigint").alias("feed_timestamp")), ts).first()
    assert (str(df.date), df.hour) == ("2026-07-30", 14)


def test_rerun_of_one_poll_overwrites_only_that_poll(spark, golden, tmp_root):
    p1, p2 = _polls(golden, 1785421500), _polls(golden, 1785421560)
    sinks.write_realtime(p1, tmp_root, "trip_updates")
    sinks.write_realtime(p2, tmp_root, "trip_updates")
    sinks.write_realtime(p1, tmp_root, "trip_updates")  # rerun
    got = read_realtime(spark, tmp_root, "trip_updates")
    assert got.count() == 8
    assert {r.poll for r in got.select("poll").distinct().collect()} == {"20260730T142500", "20260730T142600"}


def test_empty_poll_writes_nothing(spark, golden, tmp_root):
    empty = _polls(golden, 1785421500).limit(0)
    sinks.write_realtime(empty, tmp_root, "trip_updates")
    assert read_realtime(spark, tmp_root, "trip_updates").count() == 0


def test_missing_sources_read_empty(spark, tmp_root):
    assert read_manifest(spark, tmp_root).count() == 0
    assert read_realtime(spark, tmp_root, "vehicle_positions").count() == 0


def test_hex_version_prefix_stays_text(spark, tmp_root):
    df = spark.createDataFrame(
        [("S1", "a", "1", "2", "012345678901"), ("S2", "b", "1", "2", "12e456789012")],
        "stop_id string, stop_name string, stop_lat string, stop_lon string, version string",
    )
    sinks.write_static(df, tmp_root, "stops")
    from headway.sources.readers import read_static

    got = {r.version for r in read_static(spark, tmp_root, "stops").collect()}
    assert got == {"012345678901", "12e456789012"}


def test_load_truncate_replaces_contents(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.range(5)
    assert sinks.load_truncate(df, target) == 5
    assert sinks.load_truncate(df, target) == 5
    assert spark.read.parquet(target).count() == 5


def test_publish_noop_without_target(spark):
    assert sinks.publish_marts(spark, {"x": spark.range(1)}, None).count() == 0


def test_publish_marts_round_trip(spark, golden, tmp_path):
    marts = {m: golden.mart(m) for m in ("dim_stops", "dim_routes", "dim_trips", "fct_stop_events")}
    out = {r.table_name: r.n_rows for r in sinks.publish_marts(spark, marts, str(tmp_path / "pub")).collect()}
    assert out == {"dim_stops": 3, "dim_routes": 2, "dim_trips": 4, "fct_stop_events": 4}
    out2 = {r.table_name: r.n_rows for r in sinks.publish_marts(spark, marts, str(tmp_path / "pub")).collect()}
    assert out2 == out


def test_blob_name(tmp_path):
    root = str(tmp_path)
    assert sinks.blob_name(f"{root}/trip_updates/date=2026-07-30/hour=8/x.parquet", root) == (
        "trip_updates/date=2026-07-30/hour=8/x.parquet"
    )
    assert sinks.blob_name("file:/data//zone/./a/../b.parquet", "/data/zone/") == "b.parquet"
    assert sinks.blob_name("s3://bucket/zone/a.parquet", "s3://bucket/zone") == "a.parquet"
    outside = [
        (str(tmp_path.parent / "elsewhere.parquet"), root),
        ("/data/zone/../secret/x.parquet", "/data/zone"),
        ("/data/zone-2/x.parquet", "/data/zone"),
        ("/data/zone", "/data/zone"),
        ("s3://other/zone/a.parquet", "s3://bucket/zone"),
        ("/data/zonefile:/x", "/data/zone"),
    ]
    for path, base in outside:
        with pytest.raises(ValueError, match="is not below"):
            sinks.blob_name(path, base)


def test_mirror_keeps_partitions(spark, golden_root, tmp_path):
    dst = str(tmp_path / "mirror")
    uris = sinks.mirror_dataset(
        spark, golden_root, "trip_updates", dst, schemas.TRIP_UPDATES_LANDED, ("date", "hour", "poll")
    ).collect()
    polls = {"date=2031-03-05/hour=9/poll=20310305T091100", "date=2031-03-12/hour=9/poll=20310312T091500"}
    assert {u.uri.partition("trip_updates/")[2].rpartition("/")[0] for u in uris} == polls
    assert read_realtime(spark, dst, "trip_updates").count() == 4
    assert sinks.mirror_dataset(spark, golden_root, "trip_updates", None, schemas.TRIP_UPDATES_LANDED, ()).count() == 0


def test_mirror_of_one_poll_leaves_the_rest(spark, golden_root, tmp_path):
    dst = str(tmp_path / "mirror")
    uris = sinks.mirror_dataset(
        spark, golden_root, "trip_updates", dst, schemas.TRIP_UPDATES_LANDED, ("date", "hour", "poll"),
        only=F.col("poll") == "20310305T091100",
    ).collect()
    assert len(uris) == 1 and "poll=20310305T091100" in uris[0].uri
    assert {r.poll for r in read_realtime(spark, dst, "trip_updates").collect()} == {"20310305T091100"}


def test_one_large_poll_is_written_by_many_tasks(spark, golden, tmp_root):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    poll = _polls(golden, 1785421500).crossJoin(spark.range(3000).select()).repartition(8)
    try:
        spark.conf.set(size, "16k")
        sinks.write_realtime(poll, tmp_root, "trip_updates", one_file_per_poll=True)
    finally:
        spark.conf.set(size, old)
    files = read_realtime(spark, tmp_root, "trip_updates").select("_metadata.file_path").distinct().count()
    assert files > 1 and read_realtime(spark, tmp_root, "trip_updates").count() == 12000


def test_append_manifest(spark, tmp_root):
    rows = spark.createDataFrame([("a" * 64, "2026-07-30T04:00:00", "20260730", "20260801")], schemas.VERSIONS)
    sinks.append_manifest(rows, tmp_root)
    sinks.append_manifest(rows.withColumn("version", F.lit("b" * 64)), tmp_root)
    assert read_manifest(spark, tmp_root).count() == 2
    assert os.path.isdir(f"{tmp_root}/gtfs_static/versions")


def test_since_prunes_realtime_partitions(spark, golden_root):
    import datetime as dt
    import io
    from contextlib import redirect_stdout

    from headway.sources.readers import load_landing

    raw = load_landing(spark, golden_root, since=dt.date(2031, 3, 13))
    assert raw.trip_updates.count() == 0
    assert load_landing(spark, golden_root, since=dt.date(2031, 3, 12)).trip_updates.count() == 3
    buf = io.StringIO()
    with redirect_stdout(buf):
        raw.trip_updates.explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()


def test_polls_are_replaced_whole_and_others_stay(spark, tmp_root):
    """Folders that are new move whole; where both have a folder, only polls with new rows change."""
    from headway.plans.files import Files, replace_partitions

    def rows(*polls):
        return spark.createDataFrame([(v, f"2031-03-{d:02d}", h, p) for v, d, h, p in polls], "v int, date string, hour int, poll string")

    replace_partitions(rows((1, 5, 8, "a"), (2, 5, 8, "b"), (3, 5, 9, "c"), (4, 6, 0, "d"), (40, 6, 0, "d")), tmp_root, ("date", "hour", "poll"))
    replace_partitions(rows((5, 5, 8, "b"), (6, 5, 10, "e"), (7, 7, 0, "f"), (8, 6, 0, "d")), tmp_root, ("date", "hour", "poll"))
    replace_partitions(rows(), tmp_root, ("date", "hour", "poll"))
    got = spark.read.parquet(tmp_root).select("v", "hour", "poll")
    assert sorted(map(tuple, got.collect())) == [(1, 8, "a"), (3, 9, "c"), (5, 8, "b"), (6, 10, "e"), (7, 0, "f"), (8, 0, "d")]
    assert Files(spark).names(tmp_root) == ["date=2031-03-05", "date=2031-03-06", "date=2031-03-07"]
    assert os.listdir(f"{tmp_root}/date=2031-03-06/hour=0") == ["poll=d"]
    assert not [n for n in os.listdir(tmp_root) if n.startswith("_writing")]


def test_days_whose_polls_are_all_written_again_are_not_walked(spark, tmp_root, monkeypatch):
    """A rerun moves a day as one folder; only a day that keeps an older poll is walked."""
    from headway.plans.files import Files, replace_partitions

    def rows(polls, v):
        return spark.createDataFrame([(v, f"2031-03-{d:02d}", h, p) for d, h, p in polls], "v int, date string, hour int, poll string")

    polls = [(d, h, f"{d}-{h}") for d in (5, 6, 7, 8) for h in range(3)]
    replace_partitions(rows(polls, 1), tmp_root, ("date", "hour", "poll"))
    listed, names = [], Files.names
    monkeypatch.setattr(Files, "names", lambda self, path: listed.append(path) or names(self, path))
    replace_partitions(rows(polls[1:] + [(7, 0, "new"), (9, 0, "later")], 2), tmp_root, ("date", "hour", "poll"))
    got = sorted((r.poll, r.v) for r in spark.read.parquet(tmp_root).collect())
    assert got == sorted([(p, 2) for _, _, p in polls[1:]] + [("5-0", 1), ("new", 2), ("later", 2)])
    walked = {p.rpartition("date=")[2].partition("/")[0] for p in listed if "date=" in p}
    assert walked == {"2031-03-05"}


def test_local_partitions_are_written_without_a_process_each(spark, tmp_root):
    """Names, values and rows as Spark's own writer has them, without a checksum file or a process for permissions."""
    from pathlib import Path

    from headway.plans.files import write_partitions

    schema = "n long, at timestamp_ntz, x float, date date, hour int, poll string"
    when = dt.datetime(2031, 3, 5, 9, 11)
    keys = [(dt.date(2031, 3, 5), 9, "20310305T09:11"), (None, None, None), (dt.date(2031, 3, 5), 10, "a b=c/d%"), (dt.date(2031, 3, 6), 0, "")]
    rows = [(k, when, 0.5 if k % 2 else None, *keys[k % 4]) for k in range(40)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    parts = ("date", "hour", "poll")
    write_partitions(df, f"{tmp_root}/own", parts)
    df.write.partitionBy(*parts).parquet(f"{tmp_root}/spark")

    def folders(root):
        return sorted(str(p.parent.relative_to(root)) for p in Path(root).rglob("part-*.parquet"))

    assert folders(f"{tmp_root}/own") == folders(f"{tmp_root}/spark")
    assert not list(Path(f"{tmp_root}/own").rglob("*.crc")) and not Path(f"{tmp_root}/own/_attempts").exists()
    own, other = (sorted(map(str, spark.read.schema(schema).parquet(f"{tmp_root}/{x}").collect())) for x in ("own", "spark"))
    assert own == other and len(own) == 40


def test_rows_of_a_partition_in_several_batches_make_one_file(spark, tmp_root):
    from pathlib import Path

    from headway.plans.files import write_partitions

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        write_partitions(spark.range(100, numPartitions=1).withColumn("k", F.col("id") % 3), tmp_root, ("k",))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(list(Path(tmp_root).rglob("*.parquet"))) == 3
    assert spark.read.parquet(tmp_root).count() == 100

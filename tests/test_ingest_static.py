"""Archive ingest: many zips in one run, kept columns, windows, replaced files."""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import io
import os
import zipfile

import pytest

from headway.plans import ingest
from headway.sources import archives as arc
from headway.sources.readers import read_manifest, read_static, read_static_all_columns

HEADERS = {
    "stops": ["stop_name", "stop_id", "platform", "stop_lat", "stop_lon"],
    "routes": ["route_id", "route_short_name", "route_type", "colour"],
    "trips": ["trip_id", "route_id", "service_id"],  # no direction
    "stop_times": ["trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time"],
    "calendar_dates": ["date", "service_id", "exception_type"],
}


def feed(folder, name, days, mark="", leave_out=(), empty=(), folders=(), stored=None):
    """One archive: a tram line of three halts on the given days."""
    rows = {
        "stops": [[f"Halt, {k}{mark}", f"h{k}", f"p{k}", "50.0", "9.0"] for k in range(3)],
        "routes": [["tram", 'the "T"', "0", "green"]],
        "trips": [["t1", "tram", "all"]],
        "stop_times": [["t1", str(k), f"h{k}", f"23:5{k}:00", f"23:5{k}:30"] for k in range(3)],
        "calendar_dates": [[d, "all", "1"] for d in days],
    }
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with zipfile.ZipFile(path, "w") as z:
        for table, header in HEADERS.items():
            if table in leave_out:
                continue
            text = io.StringIO()
            csv.writer(text).writerows([header, *([] if table in empty else rows[table])])
            body = text.getvalue().encode("utf-8-sig")  # editors on some systems add the mark
            z.writestr(f"{table}.txt", body)
            for inner in folders:
                z.writestr(f"{inner}/{table}.txt", body)
    if stored:
        os.utime(path, (stored.timestamp(), stored.timestamp()))
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


@pytest.fixture
def zone(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "zone")


def report(df):
    return {r.version: r for r in df.collect()}


def test_one_run_takes_many_archives(spark, zone):
    folder, root = zone
    stored = [dt.datetime(2032, 1, d, 5, 30, tzinfo=dt.timezone.utc) for d in (1, 2)]
    a = feed(folder, "a.zip", ["20320110", "20320105"], stored=stored[0], folders=["old"])
    b = feed(folder, "b.zip", ["20320201"], mark="!", stored=stored[1])
    assert feed(folder, "copy-of-b.zip", ["20320201"], mark="!", stored=stored[1]) == b
    got = report(ingest.ingest_archives(spark, folder, root))
    assert {v: (r.status, r.valid_from, r.valid_to, r.skipped_tables) for v, r in got.items()} == {
        a: ("ingested", "20320105", "20320110", []),
        b: ("ingested", "20320201", "20320201", []),
    }
    # each archive keeps the time at which its own file was stored
    manifest = {r.version: r.downloaded_at for r in read_manifest(spark, root).collect()}
    assert manifest == {a: "2032-01-01T05:30:00", b: "2032-01-02T05:30:00"}
    stops = read_static(spark, root, "stops").collect()
    assert sorted((r.version, r.stop_id, r.stop_name) for r in stops) == sorted(
        (v[:12], f"h{k}", f"Halt, {k}{m}") for v, m in ((a, ""), (b, "!")) for k in range(3)
    )
    assert {r.direction_id for r in read_static(spark, root, "trips").collect()} == {None}
    assert {r.status for r in ingest.ingest_archives(spark, folder, root).collect()} == {"skipped"}
    assert read_manifest(spark, root).count() == 2 and read_static(spark, root, "stops").count() == 6


def test_every_column_is_landed(spark, zone):
    folder, root = zone
    feed(folder, "a.zip", ["20320101"])
    ingest.ingest_archives(spark, folder, root)
    stops = read_static_all_columns(spark, root, "stops")
    assert {(r.stop_id, r.platform) for r in stops.collect()} == {(f"h{k}", f"p{k}") for k in range(3)}
    assert read_static_all_columns(spark, root, "routes").first().colour == "green"


def test_absent_and_empty_tables_are_reported(spark, zone):
    folder, root = zone
    v = feed(folder, "a.zip", [], leave_out=["routes"], empty=["calendar_dates", "trips"])
    got = report(ingest.ingest_archives(spark, folder, root, now=dt.datetime(2032, 5, 5, 1, 2, 3)))[v]
    assert (got.status, got.valid_from, got.valid_to) == ("ingested", "", "")
    assert got.skipped_tables == ["calendar_dates", "routes", "trips"]
    assert read_manifest(spark, root).first().downloaded_at == "2032-05-05T01:02:03"


def test_an_archive_replaced_during_the_run_waits(spark, zone, monkeypatch):
    folder, root = zone
    first = feed(folder, "a.zip", ["20320101"])
    unpack = arc.unpack_archives

    def meanwhile(archives):
        feed(folder, "a.zip", ["20320303"], mark="?")
        return unpack(archives)

    monkeypatch.setattr(arc, "unpack_archives", meanwhile)
    assert report(ingest.ingest_archives(spark, folder, root))[first].status == "changed"
    assert read_manifest(spark, root).count() == 0 and read_static(spark, root, "stops").count() == 0
    monkeypatch.undo()
    (second,) = report(ingest.ingest_archives(spark, folder, root)).values()
    assert second.status == "ingested" and second.valid_from == "20320303" and second.version != first


def test_versions_of_one_prefix_are_refused(spark):
    rows = spark.createDataFrame([("a" * 12 + "0" * 52,), ("b" * 64,)], "version string")
    ingest.refuse_prefix_collisions(rows, rows)
    other = spark.createDataFrame([("a" * 12 + "1" * 52,)], "version string")
    with pytest.raises(ValueError, match="share the prefix aaaaaaaaaaaa"):
        ingest.refuse_prefix_collisions(rows, other)


def test_columns_are_known_without_unpacking_whole_archives(spark, monkeypatch):
    """``first_rows`` names the columns that all rows have; ``table_rows`` then looks nowhere else."""
    import io
    import zipfile

    from headway.sources import archives as arc

    def packed(version, text):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as z:
            z.writestr("stops.txt", text)
        return version, body.getvalue()

    texts = ["stop_id,zone\n" + "".join(f"{k},A\n" for k in range(50)), "stop_id,area\nq,B\n", "stop_id,never\n"]
    archives = spark.createDataFrame([packed(f"{k}" * 20, t) for k, t in enumerate(texts)], "version string, content binary")
    first, rows = arc.first_rows(archives), arc.unpack_archives(archives)
    assert first.where("table_name = 'stops'").count() == 2 and rows.where("table_name = 'stops'").count() == 51
    plain, named = arc.table_rows(rows, "stops"), arc.table_rows(rows, "stops", named_by=first)
    assert named.columns == plain.columns and {"zone", "area"} < set(named.columns) and "never" not in named.columns
    assert sorted(map(str, named.collect())) == sorted(map(str, plain.collect()))
    assert arc.table_rows(rows, "stops", named_by=first.limit(0)).columns == [c for c in plain.columns if c not in ("zone", "area")]

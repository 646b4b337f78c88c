"""The member-level archive source and its ingest: partitions, broken files, statuses."""

from __future__ import annotations

import io
import os
import zipfile

import pytest

from headway.plans.archive_ingest import ingest_members
from headway.sources.archive_members import read_index, read_members
from headway.sources.readers import read_manifest, read_static

TABLES = {
    "stops.txt": "stop_id,stop_name,stop_lat,stop_lon,zone\nquay,Quay,1.0,2.0,A\n",
    "routes.txt": "route_id,route_short_name,route_type\nL1,One,3\n",
    "trips.txt": "route_id,service_id,trip_id,direction_id\nL1,w,t1,0\n",
    "stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n" + "".join(f"t1,08:{k % 60:02d}:00,08:{k % 60:02d}:30,quay,{k}\n" for k in range(25_000)),
    "calendar_dates.txt": "service_id,date,exception_type\nw,20310301,1\nw,20310309,2\n",
}


def archive(**changed) -> bytes:
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in {**TABLES, **changed}.items():
            if text is not None:
                z.writestr(name, "﻿" + text)
        z.writestr("old/stops.txt", "stop_id\nnever\n")
    return body.getvalue()


def torn(content: bytes, member: str) -> bytes:
    """The archive with some bytes inside a member turned over."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        at = z.getinfo(member).header_offset + 30 + len(member) + 40
    return content[:at] + bytes(b ^ 0xFF for b in content[at : at + 60]) + content[at + 60 :]


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "zips"
    where.mkdir()
    whole = archive()
    files = {
        "a.zip": whole,
        "b.zip": whole,  # the same bytes
        "c.zip": archive(**{"calendar_dates.txt": None, "routes.txt": "route_id,route_short_name,route_type\n"}),
        "d.zip": whole[: len(whole) // 2],  # no central directory
        "e.zip": torn(archive(**{"trips.txt": None}), "stop_times.txt"),
        "f.txt": b"no archive",
    }
    for name, content in files.items():
        (where / name).write_bytes(content)
    return where


def test_partitions_are_members(spark, folder):
    rows = read_members(spark, str(folder))
    assert rows.rdd.getNumPartitions() > 5  # more than there are archives
    counts = {(os.path.basename(r.path), r.table_name): r["count"] for r in rows.where("error IS NULL").groupBy("path", "table_name").count().collect()}
    assert counts["a.zip", "stop_times"] == 25_000 and counts["a.zip", ""] == 1 and ("c.zip", "calendar_dates") not in counts
    assert {r.row["stop_name"] for r in rows.where("table_name = 'stops'").collect()} == {"Quay"}
    errors = {(os.path.basename(r.path), r.table_name) for r in rows.where("error IS NOT NULL").collect()}
    assert errors == {("d.zip", ""), ("e.zip", "stop_times")}


def test_index_hashes_and_tells_what_is_broken(spark, folder):
    import hashlib

    got = {os.path.basename(r.path): r for r in read_index(spark, str(folder)).collect()}
    assert set(got) == {"a.zip", "b.zip", "c.zip", "d.zip", "e.zip"}
    assert all(r.version == hashlib.sha256((folder / name).read_bytes()).hexdigest() for name, r in got.items())
    assert [name for name, r in got.items() if r.error] == ["d.zip"]
    assert read_index(spark, str(folder / "none")).count() == 0 and read_members(spark, str(folder / "none")).count() == 0


def test_ingest_statuses_and_tables(spark, folder, tmp_root):
    def run():
        return {os.path.basename(r.path): r for r in ingest_members(spark, str(folder), tmp_root, "2031-02-01T00:00:00").collect()}

    got = run()
    assert {k: r.status for k, r in got.items()} == {"a.zip": "ingested", "b.zip": "skipped", "c.zip": "ingested", "d.zip": "broken", "e.zip": "broken"}
    assert (got["a.zip"].valid_from, got["a.zip"].valid_to, got["a.zip"].skipped_tables) == ("20310301", "20310309", [])
    assert (got["c.zip"].valid_from, got["c.zip"].skipped_tables) == ("", ["calendar_dates", "routes"])
    assert "BadZipFile" in got["d.zip"].error and got["e.zip"].error
    assert read_manifest(spark, tmp_root).count() == 2
    assert read_static(spark, tmp_root, "stop_times").count() == 50_000
    # again, with the torn archive mended
    (folder / "e.zip").write_bytes(archive(**{"trips.txt": None}))
    assert {k: r.status for k, r in run().items()} == {"a.zip": "skipped", "b.zip": "skipped", "c.zip": "skipped", "d.zip": "broken", "e.zip": "ingested"}
    assert read_manifest(spark, tmp_root).count() == 3


def test_small_members_share_tasks_and_large_ones_do_not():
    from headway.sources.archive_members import LEAST_TASKS, TASK_BYTES, Archive, _dealt

    few = [Archive(f"{k}.zip", 1, "") for k in range(20)]
    assert [t.parts for t in _dealt(few)] == [[p] for p in few]
    many = [Archive(f"{k}.zip", 1, "", stored=TASK_BYTES if k == 7_000 else 20_000) for k in range(20_000)]
    tasks = _dealt(many)
    assert [p for t in tasks for p in t.parts] == many and LEAST_TASKS <= len(tasks) < 500
    assert [many[7_000]] in [t.parts for t in tasks]
    assert [t.parts for t in _dealt([])] == [[]]


def test_members_of_one_task_are_read_one_by_one(spark, folder, monkeypatch):
    from headway.sources import archive_members as am

    parts = [m for a in am._listed(str(folder)) for m in am._members(a)]
    alone = [b for p in parts for b in am._MembersReader(str(folder)).read(am.Parts([p]))]
    together = list(am._MembersReader(str(folder)).read(am.Parts(parts)))
    assert am.pa.Table.from_batches(alone).equals(am.pa.Table.from_batches(together))
    assert sum(b.num_rows for b in am._IndexReader(str(folder)).read(am.Parts(am._listed(str(folder))))) == 5

"""Shared fixtures: one local Spark session and a small landing zone.

The zone is a harbour town's timetable.  Its spring version replaces the winter
one from 10 March on (their windows overlap until the 31st) and leaves the
harbour two minutes later.  Every expected value in the tests is worked out by
hand from the rows below.
"""

from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from headway import schemas  # noqa: E402
from headway.plans import sinks  # noqa: E402
from headway.plans.ingest import with_poll_partitions  # noqa: E402
from headway.session import build_session  # noqa: E402

WINTER, SPRING = "0c1d2e3f4a5b" + "11" * 26, "9f8e7d6c5b4a" + "22" * 26
#: Polls: on a day that only winter covers, and on one that both do (epoch seconds, UTC).
EARLY_POLL = int(dt.datetime(2031, 3, 5, 9, 11, tzinfo=dt.timezone.utc).timestamp())
POLL = int(dt.datetime(2031, 3, 12, 9, 15, tzinfo=dt.timezone.utc).timestamp())

TIMETABLE = {
    "stops": [("harbour", "Harbour Gate", "54.10", "10.20"), ("mill", "Old Mill", "54.20", "10.30"), ("depot", "Depot", None, None)],
    "routes": [("L7", "Line 7", "3"), ("N2", "Night 2", "3")],
    "trips": [("L7", "weekday", "m100", "0"), ("N2", "weekday", "m200", "1")],
    "calendar_dates": [("weekday", "20310305", "1"), ("weekday", "20310312", "1")],
}
STOP_TIMES = {
    WINTER: [("m100", "09:10:00", "09:10:30", "harbour", "1"), ("m100", "09:20:00", "09:21:00", "mill", "2"), ("m200", "24:50:00", "24:50:00", "mill", "1")],
    SPRING: [("m100", "09:12:00", "09:12:30", "harbour", "1"), ("m100", "09:20:00", "09:21:00", "mill", "2"), ("m200", "24:50:00", "24:50:00", "mill", "1")],
}
#: poll, trip, route, date, sequence, stop, arrival delay, departure delay
OBSERVED = [
    (EARLY_POLL, "m100", "L7", "20310305", 1, "harbour", 0, 0),
    (POLL, "m100", "L7", "20310312", 1, "harbour", 45, 50),
    (POLL, "m100", "L7", "20310312", 2, "mill", -90, -80),
    (POLL, "m200", "N2", "20310312", 1, "mill", 400, 410),
]


@pytest.fixture(scope="session")
def spark():
    # few rows: compiling each plan would take longer than running it
    s = build_session("local[4]", "headway-tests", shuffle_partitions=4, extra={"spark.sql.codegen.wholeStage": "false"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="headway-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_root(tmp_path) -> str:
    return str(tmp_path / "zone")


def write_golden(spark, root: str) -> None:
    sinks.append_manifest(
        spark.createDataFrame(
            [(WINTER, "2031-03-01T02:30:00", "20310301", "20310331"), (SPRING, "2031-03-09T02:30:00", "20310310", "20310430")],
            schemas.VERSIONS,
        ),
        root,
    )
    for version in (WINTER, SPRING):
        for table, rows in {**TIMETABLE, "stop_times": STOP_TIMES[version]}.items():
            columns = ", ".join(f"{c} string" for c in [*schemas.STATIC_COLUMNS[table], "version"])
            sinks.write_static(spark.createDataFrame([(*r, version[:12]) for r in rows], columns), root, table)

    updates = [
        (poll, f"{trip}/{date}", trip, route, 0, date, "09:00:00", "bus 4", "Bus 4", seq, stop, arrival, poll, departure, poll, 0)
        for poll, trip, route, date, seq, stop, arrival, departure in OBSERVED
    ]
    flat = spark.createDataFrame(updates, schemas.TRIP_UPDATES)
    sinks.write_realtime(with_poll_partitions(flat), root, "trip_updates")
    place = (POLL, "bus 4", "m100", "L7", 0, "20310312", "09:00:00", "bus 4", "Bus 4", 54.15, 10.25, 90.0, 7.5, 1, "harbour", 2, POLL)
    position = spark.createDataFrame([place], schemas.VEHICLE_POSITIONS)
    sinks.write_realtime(with_poll_partitions(position), root, "vehicle_positions")


@pytest.fixture(scope="session")
def golden_root(spark) -> str:
    root = tempfile.mkdtemp(prefix="headway-golden-") + "/zone"
    write_golden(spark, root)
    return root


@pytest.fixture(scope="session")
def golden(spark, golden_root):
    from headway.plans.warehouse import Warehouse
    from headway.sources.readers import load_landing

    return Warehouse(load_landing(spark, golden_root))

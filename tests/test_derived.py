"""The schedule derived from the driver's tables: whole, and in tasks of a bounded size."""

from __future__ import annotations

import datetime as dt

from headway import schemas
from headway.operators import flatten
from headway.plans import registry
from headway.sources import derived


def _tables(spark, root: str, orders: int, lines: int) -> str:
    """Orders from one day on, a week apart; lines 1 to ``lines``, the first of each twice."""
    day = dt.datetime(2031, 1, 6)
    rows = [(k, 1, "O", 1.0, day + dt.timedelta(weeks=k), "1") for k in range(orders)]
    spark.createDataFrame(rows, derived.DRIVER_SCHEMAS["orders"]).write.parquet(f"{root}/orders.parquet")
    numbers = [1, *range(1, lines + 1)]
    rows = [(k, 1, 1, n, 1.0, 1.0, 0.0, 0.0, "N", "O", day) for k in range(orders) for n in numbers]
    rows += [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", day), (orders + 7, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", day)]
    spark.createDataFrame(rows, derived.DRIVER_SCHEMAS["lineitem"]).write.parquet(f"{root}/lineitem.parquet")
    return root


def test_listed_keys_once_in_tasks_that_grow_with_the_lines(spark, tmp_path, monkeypatch):
    sf = _tables(spark, str(tmp_path), orders=20, lines=6)
    monkeypatch.setattr(derived, "TASK_LINES", 10, raising=False)
    # weeks 0 to 12 begin in the first quarter, 13 to 19 in the second; the first covers all days until 1 May
    covers = {k: 1 if k < 13 else 2 if k < 17 else 1 for k in range(20)}
    keys = [(k, n) for k in range(20) for n in range(1, 7) if (k + n) % 23]
    times, trips = derived.stop_times(spark, sf), derived.trips(spark, sf)
    assert times.count() == times.select("version", "trip_id", "stop_sequence").distinct().count() == sum(covers[k] for k, _ in keys)
    assert trips.count() == trips.distinct().count() == sum(covers[k] for k in {k for k, _ in keys})
    for table in (times, trips):  # 142 lines
        assert table.rdd.getNumPartitions() == 15


def test_message_files_grow_with_the_updates(spark, tmp_path, monkeypatch):
    sf = _tables(spark, str(tmp_path), orders=20, lines=6)
    monkeypatch.setattr(registry, "_FILE_UPDATES", 10, raising=False)
    files = registry._message_files(spark, sf, 4)
    assert files == 14  # 142 lines
    updates = derived.trip_updates(spark, sf)
    registry._send(updates, 1, str(tmp_path / "inbox"), files)
    sent = spark.read.schema(schemas.FEED_MESSAGE).parquet(str(tmp_path / "inbox"))
    assert len(sent.inputFiles()) == files
    assert flatten.flatten_trip_updates(sent).count() == updates.count() == 140
    monkeypatch.setattr(registry, "_FILE_UPDATES", 1000)
    assert registry._message_files(spark, sf, 4) == 4


def test_stored_tables_are_derived_once(spark, tmp_path):
    """A stored table has the same rows and no longer reads the driver's tables."""
    import datetime as dt

    from headway.sources import derived

    spark.createDataFrame([(1, 7, "O", 1.0, dt.datetime(1995, 2, 3), "x")], derived.DRIVER_SCHEMAS["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 5, 2, n, 3.0, 1.0, 0.0, 0.0, "A", "F", dt.datetime(1995, 3, 1)) for n in (1, 2)]
    spark.createDataFrame(lines, derived.DRIVER_SCHEMAS["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    names = ("stop_times", "trip_updates")
    plain, stored = derived.load_derived(spark, str(tmp_path)), derived.load_derived(spark, str(tmp_path)).store(*names)
    for name in names:
        before, after = getattr(plain, name), getattr(stored, name)
        assert after.count() > 0 and after.dtypes == before.dtypes and sorted(map(str, after.collect())) == sorted(map(str, before.collect()))
        assert not any(f.endswith(("orders.parquet", "lineitem.parquet")) or "/lineitem.parquet/" in f or "/orders.parquet/" in f for f in after.inputFiles())

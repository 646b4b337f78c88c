"""The partition walk: what is listed and opened does not grow with history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from headway import schemas
from headway.operators import quality
from headway.plans import sinks
from headway.plans.files import Files
from headway.plans.ingest import with_poll_partitions
from headway.sources import newest

START = int(dt.datetime(2031, 1, 1, tzinfo=dt.timezone.utc).timestamp())


def land(spark, root, polls, step):
    """One row a poll, ``step`` seconds apart."""
    df = spark.range(polls).select((F.lit(START) + F.col("id") * step).cast("bigint").alias("feed_timestamp"))
    for f in schemas.TRIP_UPDATES.fields[1:]:
        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    sinks.write_realtime(with_poll_partitions(df), root, "trip_updates", one_file_per_poll=True)


def test_cost_is_flat_in_history(spark, tmp_path, monkeypatch):
    listed = []
    names = Files.names
    monkeypatch.setattr(Files, "names", lambda self, path: listed.append(path) or names(self, path))
    costs = []
    for k, polls in enumerate((20, 200)):
        root = str(tmp_path / f"zone{k}")
        land(spark, root, polls, 5400)
        listed.clear()
        files = newest.newest_poll_files(spark, root, "trip_updates")
        costs.append((len(listed), len(files)))
        rows = newest.newest_poll(spark, root, "trip_updates")
        assert len(rows.inputFiles()) == 1
        assert quality.latest_rt_feed_timestamp(rows).first()[0] == START + (polls - 1) * 5400
    assert costs[0] == costs[1] == (4, 1)


def test_empty_folders_and_hours_as_numbers(spark, tmp_path):
    root = str(tmp_path / "zone")
    assert newest.newest_poll(spark, root, "trip_updates").count() == 0
    land(spark, root, 11, 3600)  # hours 0 to 10: 10 comes after 9
    (tmp_path / "zone/trip_updates/date=2031-01-02/hour=3/poll=20310102T030000").mkdir(parents=True)
    (tmp_path / "zone/trip_updates/_temporary").mkdir()
    assert [r.feed_timestamp for r in newest.newest_poll(spark, root, "trip_updates").collect()] == [START + 36000]

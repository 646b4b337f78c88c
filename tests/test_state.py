"""Keyed state of the newest observation: any order, corrections, expiry, late rows."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from headway import schemas
from headway.operators import staging
from headway.plans.ingest import with_poll_partitions
from headway.streaming import realtime as rt
from headway.streaming import state as st
from headway.streaming.ledger import PollLedger

FLAT = schemas.TRIP_UPDATES.fieldNames()
COLUMNS = ["service_date", "trip_id", "stop_sequence", "feed_timestamp", "stop_id", "arrival_delay", "departure_delay", "vehicle_label"]


def rows_of(spark, observed):
    """observed: (feed time, trip, date, sequence, arrival delay, status)"""
    full = [
        (t, f"{trip}/{k}", trip, "L1", 0, f"{day:%Y%m%d}", "", "v", "V", seq, "stop", delay, None, None, None, status)
        for k, (t, trip, day, seq, delay, status) in enumerate(observed)
    ]
    return with_poll_partitions(spark.createDataFrame(full, schemas.TRIP_UPDATES), poll_seconds=3600)


def drain(spark, feed, out, chk, **kw):
    q = st.stream_latest_state(spark, f"{feed.root}/changes", out, chk, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def batch(feed):
    return sorted(map(str, rt.reduce_latest(staging.stg_trip_updates(feed.read())).select(*COLUMNS).collect()))


def winners(spark, out):
    return sorted(map(str, st.read_winners(spark, out).select(*COLUMNS).collect()))


def noon(day):
    return int(dt.datetime(day.year, day.month, day.day, 12, tzinfo=dt.timezone.utc).timestamp())


def random_polls(seed, days, per_day=3, trips=4):
    rnd = random.Random(seed)
    return [
        (noon(day) + 3600 * p + rnd.randrange(3000), f"t{trip}", day, rnd.randrange(1, 3), rnd.choice([None, rnd.randrange(-99, 500)]), rnd.choice([0, 0, 0, 1]))
        for day in days
        for p in range(per_day)
        for trip in range(trips)
    ]


def test_corrections_in_any_order_equal_batch(spark, tmp_path):
    days = [dt.date(2031, 5, 1) + dt.timedelta(n) for n in range(3)]
    for seed in (1, 2):
        rnd = random.Random(seed)
        feed = PollLedger(spark, str(tmp_path / f"polls{seed}"), "trip_updates")
        out, chk = str(tmp_path / f"out{seed}"), str(tmp_path / f"chk{seed}")
        deliveries = [(d, rows_of(spark, random_polls(seed * 10 + d, rnd.sample(days, 2))).withColumn("delivery", F.lit(d).cast("long"))) for d in (1, 2, 3)]
        rnd.shuffle(deliveries)
        for epoch, (_, rows) in enumerate(deliveries):
            feed.apply(rows, "run", epoch)
            if epoch != 1:  # once two commits meet in one batch
                drain(spark, feed, out, chk, delay="30 days", grace_days=60)
        assert winners(spark, out) == batch(feed) != []


def test_closed_dates_leave_the_state_and_late_rows_are_told(spark, tmp_path):
    feed = PollLedger(spark, str(tmp_path / "polls"), "trip_updates")
    out, chk = str(tmp_path / "out"), str(tmp_path / "chk")
    first = dt.date(2031, 5, 1)
    sizes = []
    for epoch in range(3):
        days = [first + dt.timedelta(10 * epoch + n) for n in range(3)]
        feed.apply(rows_of(spark, random_polls(epoch, days)).withColumn("delivery", F.lit(1).cast("long")), "run", epoch)
        q = drain(spark, feed, out, chk, delay="1 hour", grace_days=2)
        sizes.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    expected = batch(feed)
    assert winners(spark, out) == expected
    # every date but the last three is closed: the state holds no more than one round's
    assert sizes[2] <= max(sizes[:2]) * 1.5
    late = [(noon(first) + 99, "t0", first, 1, 77, 0)]
    feed.apply(rows_of(spark, late).withColumn("delivery", F.lit(2).cast("long")), "run", 3)
    drain(spark, feed, out, chk, delay="1 hour", grace_days=2)
    assert winners(spark, out) == expected
    told = st.read_late(spark, out).collect()
    assert 77 in {r.arrival_delay for r in told} and {r.service_date for r in told} == {first}


def test_nothing_yet(spark, tmp_path):
    assert st.read_winners(spark, str(tmp_path / "none")).count() == 0
    assert st.read_late(spark, str(tmp_path / "none")).count() == 0


def test_state_of_a_trip_is_read_and_stored_once():
    """However many stops a trip names; winners are told for each stop."""
    from pyspark.sql import Row

    class Held:
        value, calls = None, []

        def exists(self):
            self.calls.append("exists")
            return self.value is not None

        def get(self):
            self.calls.append("get")
            return self.value

        def update(self, value):
            self.calls.append("update")
            self.value = value

    class Handle:
        def getValueState(self, name, schema):
            return Held()

        def registerTimer(self, at):
            pass

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    def change(stop, feed_time, poll, op="+", by=None):
        own = dict.fromkeys(st.marts.OBS_ORDER) | {"feed_timestamp": feed_time}
        return Row(**own, stop_sequence=stop, poll=poll, delivery=1, run_at=1, op=op, by=by, by_run=by)

    processor, key = st.LatestObservation(2), (dt.date(2031, 5, 1), "t1")
    processor.init(Handle())
    first = list(processor.handleInputRows(key, iter([change(2, 100, "a"), change(1, 90, "a"), change(None, 95, "a"), change(2, 110, "b")]), Times()))
    assert {(r.stop_sequence, r.op, r.feed_timestamp) for r in first} == {(2, "+", 110), (1, "+", 90), (None, "+", 95)}
    second = list(processor.handleInputRows(key, iter([change(2, 110, "b", "-", 2)]), Times()))
    assert [(r.stop_sequence, r.op, r.feed_timestamp) for r in second] == [(2, "-", 110), (2, "+", 100)]
    assert Held.calls == ["get", "update"] * 2

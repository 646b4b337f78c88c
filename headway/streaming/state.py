"""Newest observation per event as keyed state (R2).

The change feed of the poll ledger goes through ``transformWithState``, keyed by
trip and service date, so that the state is read and stored once for all stops
of a trip.  It is, for each event (stop sequence) and each poll that named it,
the delivery and that delivery's newest row; the winner of an event is the
newest of its rows.  A retraction or a greater delivery takes a poll's row
back, so the winner falls to another poll's row, whatever order the changes come
in.  What comes out are signed winner changes: ``-`` the old winner, ``+`` the new.

A service date closes a while after its last second: when the watermark passes
that, a timer clears the key's state.  Changes for a closed date do not reach the
state; they come out as ``late`` and are stored apart.

    <out>/winners/epoch=<n>/   signed changes of one micro-batch
    <out>/late/epoch=<n>/      changes that came too late
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from headway.operators import marts
from headway.operators.staging import SCHEDULED
from headway.functions.dates import epoch_to_timestamp, parse_yyyymmdd
from headway.sources.readers import read_source
from headway.streaming.ledger import change_schema

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"

_TYPES = {f.name: f.dataType for f in change_schema("trip_updates").fields}
_ROW = T.StructType([T.StructField(c, _TYPES[c]) for c in marts.OBS_ORDER])
_POLL = T.StructType(
    [T.StructField("poll", T.StringType()), T.StructField("delivery", T.LongType()), T.StructField("run_at", T.LongType()), *_ROW.fields]
)
_HELD = T.StructType([T.StructField("stop_sequence", T.LongType()), *_POLL.fields])
_STATE = T.StructType([T.StructField("polls", T.ArrayType(_HELD))])
_KEY = T.StructType(
    [T.StructField("service_date", T.DateType()), T.StructField("trip_id", T.StringType()), T.StructField("stop_sequence", T.LongType())]
)
#: Columns of the signed changes.
WINNERS = T.StructType([*_KEY.fields, T.StructField("op", T.StringType()), *_ROW.fields])
_change = Row(*WINNERS.fieldNames())


def _newest(a: tuple, b: tuple) -> tuple:
    """The greater row by the columns in turn, null lowest."""
    rank = [tuple((v is not None, v if v is not None else 0) for v in r) for r in (a, b)]
    return a if rank[0] >= rank[1] else b


def _close_ms(service_date: dt.date, grace_days: int) -> int:
    """Epoch milliseconds at which a service date closes."""
    return ((service_date - dt.date(1970, 1, 1)).days + 1 + grace_days) * 86_400_000


class LatestObservation(StatefulProcessor):
    """Keeps the newest row of each poll and tells when the winner among them changes."""

    def __init__(self, grace_days: int):
        self.grace_days = grace_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        closes = _close_ms(key[0], self.grace_days)
        if closes <= timerValues.getCurrentWatermarkInMs():
            for r in rows:
                yield _change(*key, r.stop_sequence, "late", *(r[c] for c in marts.OBS_ORDER))
            return
        before = self.held.get()
        events: dict = {}  # of each stop sequence its polls
        for stop, poll, *rest in before[0] if before else ():
            events.setdefault(stop, {})[poll] = (tuple(rest[:2]), tuple(rest[2:]))
        was = {}
        for r in rows:
            polls = events.setdefault(r.stop_sequence, {})
            if r.stop_sequence not in was:
                was[r.stop_sequence] = self._winner(polls)
            mark, row = ((r.delivery, r.run_at), tuple(r[c] for c in marts.OBS_ORDER)) if r.op == "+" else ((r.by, r.by_run), None)
            have, best = polls.get(r.poll, ((-1, -1), None))
            if mark > have:
                polls[r.poll] = (mark, row)
            elif mark == have and row is not None:
                polls[r.poll] = (mark, row if best is None else _newest(best, row))
        nothing = (None,) * len(marts.OBS_ORDER)
        self.held.update(([(stop, poll, *mark, *(row or nothing)) for stop, polls in events.items() for poll, (mark, row) in sorted(polls.items())],))
        if before is None:
            self.handle.registerTimer(closes)
        for stop, old in was.items():
            now = self._winner(events[stop])
            if now != old:
                if old is not None:
                    yield _change(*key, stop, "-", *old)
                if now is not None:
                    yield _change(*key, stop, "+", *now)

    @staticmethod
    def _winner(polls: dict) -> tuple | None:
        best = None
        for _, row in polls.values():
            # a row without a feed time is none: the poll no longer names the event
            if row is not None and row[0] is not None:
                best = row if best is None else _newest(best, row)
        return best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def staged_changes(changes: DataFrame) -> DataFrame:
    """Changes of scheduled observations, with their service date and event time."""
    return changes.where(F.col("schedule_relationship") == SCHEDULED).select(
        parse_yyyymmdd("start_date").alias("service_date"),
        "trip_id",
        "stop_sequence",
        *marts.OBS_ORDER,
        "poll",
        "delivery",
        "run_at",
        "op",
        "by",
        "by_run",
        epoch_to_timestamp("feed_timestamp").alias("clock"),
    ).where("service_date IS NOT NULL AND feed_timestamp IS NOT NULL")


def stream_latest_state(
    spark: SparkSession,
    changes_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    delay: str = "1 hour",
    grace_days: int = 2,
    max_files_per_trigger: int | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    state_partitions: int | None = None,
):
    """Available-now stream of ledger changes into signed winner changes below ``out_dir``.

    ``delay``: by how much observations may trail the newest one before the
    watermark; ``grace_days``: full days a service date stays open after its
    last second.  ``out_dir`` and ``checkpoint_dir`` belong together, and the
    number of ``state_partitions`` of the first start stays with them.
    ``on_batch(changes, epoch)`` gets each batch's stored winner changes."""
    reader = spark.readStream.schema(change_schema("trip_updates")).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    staged = staged_changes(reader.parquet(changes_dir)).withWatermark("clock", delay)
    # Without its event-time column the operator gets late rows too, and reports them.
    signed = (
        staged.drop("clock")
        .groupBy("service_date", "trip_id")
        .transformWithState(LatestObservation(grace_days), WINNERS, "Update", "EventTime")
    )

    def step(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()  # one run of the stateful operator feeds both writes
        try:
            for name, rows in (("winners", held.where("op <> 'late'")), ("late", held.where("op = 'late'"))):
                rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out_dir}/{name}/epoch={epoch}")
        finally:
            held.unpersist()
        if on_batch is not None:
            on_batch(_stored(batch.sparkSession, out_dir, "winners").where(F.col("epoch") == epoch).drop("epoch"), epoch)

    wanted = {_PROVIDER: ROCKSDB} | ({_PARTITIONS: str(state_partitions)} if state_partitions else {})
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():  # a query takes the settings of its start with it
        spark.conf.set(k, v)
    try:
        return (
            signed.writeStream.outputMode("update")
            .foreachBatch(step)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _stored(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    schema = T.StructType([*WINNERS.fields, T.StructField("epoch", T.LongType())])
    return read_source(spark, out_dir, name, schema, base=name)


def read_winners(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest observation of every event, closed dates included."""
    changes = _stored(spark, out_dir, "winners")
    # of a batch's two rows of an event the new winner (+) sorts before the old one (-)
    last = F.max(F.struct(F.col("epoch"), (F.col("op") == "+").alias("won"), *[F.col(c) for c in marts.OBS_ORDER])).alias("w")
    rows = changes.groupBy(*marts.EVENT_KEY).agg(last).where("w.won")
    return rows.select(*marts.EVENT_KEY, *[F.col(f"w.{c}").alias(c) for c in marts.OBS_ORDER])


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    """Changes that came after their service date had closed."""
    return _stored(spark, out_dir, "late").drop("op", "epoch")

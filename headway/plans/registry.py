"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables at ``sf_dir`` through the derived
mapping and runs over them whole.  Column names and types match the
oracle SQL in ``headway.plans.oracle``; zoned instants are presented as
UTC wall clock (TIMESTAMP_NTZ) so results never depend on a session zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.functions.dates import epoch_to_utc_wall
from headway.functions.gtfs_time import gtfs_time_seconds, gtfs_time_to_interval
from headway.operators import analytics, constraints, flatten, intervals, marts, quality, staging, versions
from headway.plans import generations, sinks
from headway.plans.archive_ingest import ingest_members
from headway.plans.ingest import ingest_realtime, with_poll_partitions
from headway.plans.warehouse import Marts, Warehouse, write_marts
from headway.session import checkpoint_root, discard, scratch_path, shuffles_removed, stored
from headway.sources import archives, derived
from headway.sources.layouts import Zone, load_zone
from headway.sources.newest import newest_poll
from headway.sources.readers import load_landing, read_manifest, read_realtime, read_static
from headway.streaming import realtime as rt
from headway.streaming import deltas, state
from headway.streaming.ledger import PollLedger, stream_polls

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str, fact_form: str = "resolved") -> Warehouse:
    return Warehouse(derived.load_derived(spark, sf_dir), fact_form=fact_form)


def _utc_wall(column: str):
    """A staged instant, whatever the session's zone, as UTC wall clock."""
    return epoch_to_utc_wall(F.unix_seconds(column))


# ── staging ──────────────────────────────────────────────────────────────────


def q_stg_gtfs_versions(spark, sf_dir):
    return _wh(spark, sf_dir).stg_gtfs_versions


def q_stg_stops(spark, sf_dir):
    return _wh(spark, sf_dir).stg_stops


def q_stg_routes(spark, sf_dir):
    return _wh(spark, sf_dir).stg_routes


def q_stg_trips(spark, sf_dir):
    return _wh(spark, sf_dir).stg_trips


def q_stg_stop_times(spark, sf_dir):
    return staging.stg_stop_times(derived.stop_times(spark, sf_dir), as_seconds=True)


def q_stg_calendar_dates(spark, sf_dir):
    return _wh(spark, sf_dir).stg_calendar_dates


def q_stg_trip_updates(spark, sf_dir):
    return _wh(spark, sf_dir).stg_trip_updates.withColumn("feed_ts", _utc_wall("feed_ts"))


def q_stg_vehicle_positions(spark, sf_dir):
    return _wh(spark, sf_dir).stg_vehicle_positions.withColumns(
        {
            "feed_ts": _utc_wall("feed_ts"),
            "position_ts": _utc_wall("position_ts"),
        }
    )


def q_gtfs_time_to_interval(spark, sf_dir):
    st = derived.stop_times(spark, sf_dir)
    times = (
        st.select(F.col("arrival_time").alias("gtfs_time"))
        .union(st.select("departure_time"))
        .distinct()
    )
    day = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return times.select(
        "gtfs_time",
        gtfs_time_seconds("gtfs_time").alias("offset_seconds"),
        (day + gtfs_time_to_interval("gtfs_time")).alias("on_2000_01_01"),
    )


# ── versions ─────────────────────────────────────────────────────────────────


def q_validity_window(spark, sf_dir):
    m = derived.manifest(spark, sf_dir).select(versions.version_prefix("version").alias("version"))
    w = versions.validity_windows(derived.calendar_dates(spark, sf_dir))
    return m.join(w, "version", "left").select(
        "version",
        F.coalesce("valid_from", F.lit("")).alias("valid_from"),
        F.coalesce("valid_to", F.lit("")).alias("valid_to"),
    )


def q_version_dedup_anti(spark, sf_dir):
    """Candidate archives (one per lineitem ship quarter, many duplicates)
    that the manifest does not know yet."""
    li = spark.read.schema(derived.DRIVER_SCHEMAS["lineitem"]).parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    cand = li.select(
        F.md5(F.trunc(F.col("l_shipdate").cast("date"), "quarter").cast("string")).alias("version")
    )
    return versions.unseen_versions(cand, derived.manifest(spark, sf_dir))


def q_interval_join_days(spark, sf_dir):
    """J1 by the interval index: observations beside the versions that cover their date."""
    wh = _wh(spark, sf_dir)
    obs = wh.stg_trip_updates.select("service_date", "trip_id", "stop_sequence", "feed_timestamp", "entity_id")
    return intervals.match_versions(obs, wh.stg_gtfs_versions).drop("downloaded_at")


def q_interval_join_instants(spark, sf_dir):
    """The interval index over instants: updates beside the polls whose window, ten
    minutes wider than their hour on both sides, holds the update's time."""
    polls = derived.trip_updates(spark, sf_dir)
    hour = epoch_to_utc_wall(F.floor(F.col("feed_timestamp") / derived.POLL_SECONDS) * derived.POLL_SECONDS)
    windows = polls.select(hour.alias("opens")).distinct()
    wider = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10))
    closes = F.col("opens") + F.make_dt_interval(F.lit(0), F.lit(1), F.lit(10))
    index = intervals.IntervalIndex(windows, F.col("opens") - wider, closes)
    updates = polls.select("entity_id", "stop_sequence", epoch_to_utc_wall("feed_timestamp").alias("at"))
    return index.join(updates, F.col("at")).select("entity_id", "stop_sequence", "at", "opens")


# ── marts ────────────────────────────────────────────────────────────────────

_MATCH_COLUMNS = [
    "service_date",
    "trip_id",
    "route_id",
    "direction_id",
    "stop_sequence",
    "stop_id",
    "vehicle_id",
    "vehicle_label",
    "arrival_delay",
    "departure_delay",
    "feed_timestamp",
    "gtfs_version",
]


def q_version_match_range(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    vm = marts.rank_observation_versions(wh.stg_trip_updates, wh.stg_gtfs_versions)
    return vm.select(*_MATCH_COLUMNS, F.col("rn").cast("bigint").alias("rn"))


def q_latest_observation(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.latest_observation(wh.stg_trip_updates, wh.stg_gtfs_versions).select(*_MATCH_COLUMNS)


def q_dim_stops(spark, sf_dir):
    return _wh(spark, sf_dir).dim_stops


def q_dim_routes(spark, sf_dir):
    return _wh(spark, sf_dir).dim_routes


def q_dim_trips(spark, sf_dir):
    return _wh(spark, sf_dir).dim_trips


def q_fct_range(spark, sf_dir):
    return _wh(spark, sf_dir, "range").fct_stop_events


def q_fct_stop_events(spark, sf_dir):
    return _wh(spark, sf_dir).fct_stop_events


# ── analytics ────────────────────────────────────────────────────────────────


def _marts(spark, sf_dir) -> Marts:
    return Marts.of(_wh(spark, sf_dir))


def q_punctuality_by_route(spark, sf_dir):
    return _marts(spark, sf_dir).punctuality_by_route()


def q_punctuality_by_hour(spark, sf_dir):
    return _marts(spark, sf_dir).punctuality_by_hour()


def q_punctuality_by_stop(spark, sf_dir):
    return _marts(spark, sf_dir).punctuality_by_stop()


def q_delay_distribution(spark, sf_dir):
    return _marts(spark, sf_dir).delay_distribution()


def q_total_stop_events(spark, sf_dir):
    return _marts(spark, sf_dir).total_stop_events()


def q_stops_with_coordinates(spark, sf_dir):
    return analytics.stops_with_coordinates(_marts(spark, sf_dir).punctuality_by_stop())


def q_punctuality_by_route_display(spark, sf_dir):
    return analytics.for_display(_marts(spark, sf_dir).punctuality_by_route())


# ── quality ──────────────────────────────────────────────────────────────────

_UTC = dt.timezone.utc
# Fixed check times: one where the derived feeds are in the future (fresh), one
# months later (stale), one at 02:30 in Rome (quiet hours).
RT_CHECK_TIMES = [
    dt.datetime(2023, 11, 15, 6, 0, tzinfo=_UTC),
    dt.datetime(2024, 3, 1, 12, 0, tzinfo=_UTC),
    dt.datetime(2024, 3, 1, 1, 30, tzinfo=_UTC),
]
# Nine days and two months after the newest derived download.
STATIC_CHECK_TIMES = [
    dt.datetime(2001, 7, 10, 0, 0, tzinfo=_UTC),
    dt.datetime(2001, 9, 1, 0, 0, tzinfo=_UTC),
]


def q_rt_freshness(spark, sf_dir):
    d = derived.load_derived(spark, sf_dir)
    return quality.union_all(
        [
            quality.rt_freshness_status(d.trip_updates, "trip_updates", RT_CHECK_TIMES),
            quality.rt_freshness_status(d.vehicle_positions, "vehicle_positions", RT_CHECK_TIMES),
        ]
    )


def q_rt_freshness_walk(spark, sf_dir):
    """Q1/Q3 over a landing zone: only the newest poll of each feed is looked for and read."""
    root = scratch_path(spark, "zone")
    d = derived.load_derived(spark, sf_dir)
    for feed in ("trip_updates", "vehicle_positions"):
        sinks.write_realtime(getattr(d, feed), root, feed, one_file_per_poll=True)
    return quality.union_all([quality.rt_freshness_status(newest_poll(spark, root, f), f, RT_CHECK_TIMES) for f in ("trip_updates", "vehicle_positions")])


def q_static_freshness(spark, sf_dir):
    return quality.static_freshness_status(derived.manifest(spark, sf_dir), STATIC_CHECK_TIMES)


def q_check_unique(spark, sf_dir):
    return quality.unique_summary(_wh(spark, sf_dir))


def q_check_not_null(spark, sf_dir):
    return quality.not_null_summaries(_wh(spark, sf_dir))


def q_check_relationships(spark, sf_dir):
    return quality.relationship_summary(_wh(spark, sf_dir))


def q_check_delay_bounds(spark, sf_dir):
    return quality.delay_bound_violations(_wh(spark, sf_dir).fct_stop_events)


def q_constraint_checks(spark, sf_dir):
    """Q5-Q8 over stored marts: all declared tests, one scan a mart (K4: the marts are committed together)."""
    root = scratch_path(spark, "marts")
    generations.commit_marts(_wh(spark, sf_dir), root)
    return constraints.of_marts(generations.read_marts(spark, root))


def q_mart_readiness(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.mart_readiness(
        spark, {m: wh.mart(m) for m in ("dim_stops", "dim_routes", "dim_trips", "fct_stop_events")}
    )


def q_check_unique_staged(spark, sf_dir):
    """Q5 where it fails: a stop is staged once for each version that lists it."""
    return quality.unique_failures(_wh(spark, sf_dir).stg_stops, "stop_id")


def q_check_orphan_positions(spark, sf_dir):
    """Q7 where it fails: vehicle positions at stops that no version lists."""
    wh = _wh(spark, sf_dir)
    found = quality.relationship_failures(wh.stg_vehicle_positions, "stop_id", wh.dim_stops, "stop_id")
    return found.select("entity_id", "vehicle_id", "stop_id")


# ── ingest, sinks, publishing ────────────────────────────────────────────────

_TU_FLAT = schemas.TRIP_UPDATES.fieldNames()
_VP_FLAT = schemas.VEHICLE_POSITIONS.fieldNames()


def q_flatten_trip_updates(spark, sf_dir):
    """Nested messages (one per poll and entity) back to flat stop updates."""
    msgs = flatten.nest_trip_updates(derived.trip_updates(spark, sf_dir).select(*_TU_FLAT))
    return flatten.flatten_trip_updates(msgs)


def q_flatten_vehicle_positions(spark, sf_dir):
    msgs = flatten.nest_vehicle_positions(derived.vehicle_positions(spark, sf_dir).select(*_VP_FLAT))
    return flatten.flatten_vehicle_positions(msgs)


def q_write_idempotent(spark, sf_dir):
    """Land every poll twice (a rerun) and read the zone back: no duplicates."""
    root = scratch_path(spark, "landing")
    polls = derived.trip_updates(spark, sf_dir)
    for _ in range(2):
        sinks.write_realtime(polls, root, "trip_updates", one_file_per_poll=True)
    return read_realtime(spark, root, "trip_updates")


def q_publish_marts(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    target = scratch_path(spark, "published")
    names = ("dim_stops", "dim_routes", "dim_trips", "fct_stop_events")
    # Truncating loads (a rerun replaces contents; see tests/test_sinks.py).
    return sinks.publish_marts(spark, {m: wh.mart(m) for m in names}, target)


def q_mirror_dataset(spark, sf_dir):
    """Land vehicle positions, mirror them to a second root keeping the
    partition layout, and read the mirror back."""
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    sinks.write_realtime(derived.vehicle_positions(spark, sf_dir), src, "vehicle_positions", one_file_per_poll=True)
    sinks.mirror_dataset(
        spark, src, "vehicle_positions", dst, schemas.VEHICLE_POSITIONS_LANDED, ("date", "hour", "poll")
    )
    return read_realtime(spark, dst, "vehicle_positions")


def q_static_round_trip(spark, sf_dir):
    """K2 + S5: versioned stop_times written per version (twice: a rerun
    overwrites its own version partitions) and read back with the explicit
    all-text schema."""
    root = scratch_path(spark, "static")
    st = derived.stop_times(spark, sf_dir)
    for _ in range(2):
        sinks.write_static(st, root, "stop_times")
    return read_static(spark, root, "stop_times")


def q_manifest_append(spark, sf_dir):
    """K3 + S3/S4: the manifest appended in two ingest batches (versions up
    to 1997, then the rest) and read back."""
    root = scratch_path(spark, "manifest")
    m = derived.manifest(spark, sf_dir)
    early = F.col("downloaded_at") < F.lit("1998")
    sinks.append_manifest(m.where(early), root)
    sinks.append_manifest(m.where(~early), root)
    return read_manifest(spark, root)


def q_ingest_realtime(spark, sf_dir):
    """Nested vehicle-position messages flattened and landed into poll
    partitions, then read back from the landing zone."""
    root = scratch_path(spark, "rt")
    msgs = flatten.nest_vehicle_positions(derived.vehicle_positions(spark, sf_dir).select(*_VP_FLAT))
    ingest_realtime(msgs, root, "vehicle_positions", poll_seconds=derived.POLL_SECONDS)
    return read_realtime(spark, root, "vehicle_positions")


def q_content_hash(spark, sf_dir):
    """Texts by the hash of their bytes; exact copies fall together."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    hashed = docs.select(versions.content_hash(F.col("text").cast("binary")).alias("version"))
    return hashed.groupBy("version").agg(F.count(F.lit(1)).alias("n_copies"))


#: Stop times that one archive of the round trip below holds, about.
_ARCHIVE_ROWS = 20_000


def _zip_block(pdf):
    """One archive of a block of stop times; the other tables are absent or empty."""
    import io
    import zipfile

    import pandas as pd

    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("stop_times.txt", pdf.drop(columns="block").to_csv(index=False).encode("utf-8-sig"))
        z.writestr("stops.txt", "stop_id,stop_name\n")
    return pd.DataFrame({"content": [body.getvalue()]})


def _archives(spark, sf_dir):
    """Stop times packed as zip archives of bounded size, by blocks of trips."""
    checkpoint_root(spark)
    st = derived.load_derived(spark, sf_dir).store("stop_times").stop_times.withColumnRenamed("version", "listed_by")
    blocks = max(1, st.count() // _ARCHIVE_ROWS)
    packed = (
        st.withColumn("block", F.pmod(F.xxhash64("trip_id", "stop_sequence", "listed_by"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(_zip_block, "content binary")
    )
    # stored: an archive that is packed again has other bytes (times, order of rows) and so another version
    return packed.select("content", versions.content_hash("content").alias("version")).checkpoint(eager=True)


def q_archive_unpack(spark, sf_dir):
    """Archives unpacked again; a column that staging does not know comes along."""
    packed = _archives(spark, sf_dir)
    rows = archives.table_rows(archives.unpack_archives(packed), "stop_times", named_by=archives.first_rows(packed))
    return rows.drop("version").withColumnRenamed("listed_by", "version")


def q_archive_skipped_tables(spark, sf_dir):
    """Tables that the archives lack or have empty, over all archives."""
    packed = _archives(spark, sf_dir)
    lacking = archives.skipped_tables(packed, archives.unpack_archives(packed))
    return lacking.select("table_name").distinct()


#: Stop times of one archive of the ingest below, about.
_INGEST_ROWS = 5_000


def _write_archive(folder: str):
    """Write one block's archive below ``folder`` (and a broken copy of every third); which
    tables it has depends on the block."""

    def run(pdf):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs as pafs

        block = int(pdf["block"].iloc[0])
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            for table in ("stop_times", "calendar_dates"):
                rows = pdf[pdf["kind"] == table]
                columns = list(schemas.STATIC_COLUMNS[table])
                if len(rows):
                    z.writestr(f"{table}.txt", rows[columns].to_csv(index=False).encode("utf-8-sig"))
            z.writestr("stops.txt", f"stop_id,stop_name\n{block},Stop\n" if block % 2 else "stop_id,stop_name\n")
            if block % 3 == 0:
                z.writestr("routes.txt", f"route_id,route_short_name\n{block},Route\n")
        where, base = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        half = "early" if block % 2 else "late"
        whole = body.getvalue()
        for name, content in ((f"{block}.zip", whole), *([(f"{block}-torn.zip", whole[: len(whole) // 2])] if block % 3 == 1 else [])):
            for sub in {half, "late"}:
                where.create_dir(f"{base}/{sub}", recursive=True)
                with where.open_output_stream(f"{base}/{sub}/{name}") as out:
                    out.write(content)
        return pd.DataFrame({"block": [block]})

    return run


def q_archive_ingest(spark, sf_dir):
    """S7-S9, I3-I5 end to end: odd blocks' archives are ingested, then a folder with all of
    them; the report, and the stop times that each ingested archive has landed."""
    raw = derived.load_derived(spark, sf_dir).store("stop_times")
    times, cal = raw.stop_times, raw.calendar_dates
    blocks = F.lit(max(1, times.count() // _INGEST_ROWS)).cast("long")
    folder, root = scratch_path(spark, "archives"), scratch_path(spark, "zone")
    rows = times.select("*", F.lit("stop_times").alias("kind"), (F.col("trip_id").cast("long") % blocks).alias("block")).drop("version").unionByName(
        cal.select("*", F.lit("calendar_dates").alias("kind"), (F.col("date").cast("long") % blocks).alias("block")).drop("version").distinct(),
        allowMissingColumns=True,
    )
    rows.groupBy("block").applyInPandas(_write_archive(folder), "block long").count()
    ingest_members(spark, f"{folder}/early", root, "2001-01-01T00:00:00")
    report = ingest_members(spark, f"{folder}/late", root, "2001-01-02T00:00:00")
    landed = read_static(spark, root, "stop_times").groupBy("version").agg(F.count(F.lit(1)).alias("stop_times"))
    report = report.withColumn("prefix", versions.version_prefix("version"))
    return report.join(landed.withColumnRenamed("version", "prefix"), "prefix", "left").select(
        F.regexp_extract("path", r"([^/]+)\.zip$", 1).alias("archive"),
        "status",
        "valid_from",
        "valid_to",
        F.array_join("skipped_tables", ",").alias("skipped_tables"),
        F.when(F.col("status") != "broken", F.coalesce("stop_times", F.lit(0))).alias("stop_times"),
        F.col("error").isNotNull().alias("has_error"),
    )


#: Rows of one row group of a file of the other layout: what a task holds of a file, about.
_FOREIGN_ROWS = 100_000


def _write_foreign(folder: str, name: str, types: dict[str, str]):
    """Write each group as the one Parquet file that another layout has for it, a row group at a time.

    Partition columns go, unless ``types`` names them; it also gives columns' Arrow types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        def row_group(held):
            table = pa.Table.from_batches(held)
            table = table.select([c for c in table.column_names if c in types or c not in ("version", "date", "hour", "poll", "day")])
            for c, kind in types.items():
                table = table.set_column(table.column_names.index(c), c, table[c].cast(kind))
            return table

        first = next(batches)
        where, base = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        path = f"{base}/{name.format(**first.slice(0, 1).to_pylist()[0])}"
        where.create_dir(path.rpartition("/")[0], recursive=True)
        held, rows = [first], first.num_rows
        with where.open_output_stream(path) as out, pq.ParquetWriter(out, row_group(held).schema) as file:
            for batch in batches:
                if rows >= _FOREIGN_ROWS:
                    file.write_table(row_group(held))
                    held, rows = [], 0
                held.append(batch)
                rows += batch.num_rows
            file.write_table(row_group(held))
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return run


def _foreign_zone(spark, sf_dir) -> str:
    """The raw tables as a landing zone with one file a poll, table version and manifest."""
    root = scratch_path(spark, "foreign")
    raw = derived.load_derived(spark, sf_dir)
    small = {"direction_id": "uint8", "stop_sequence": "uint32", "schedule_relationship": "uint8"}
    polls = raw.trip_updates.withColumn("day", F.col("date").cast("string")).withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))
    write = _write_foreign(root, "trip_updates/date={day}/hour={hour}/{poll}.parquet", small)
    polls.groupBy("day", "hour", "poll").applyInArrow(write, "path string").count()
    for table in schemas.STATIC_TABLES:
        keep = {"date": "string"} if table == "calendar_dates" else {}
        write = _write_foreign(root, "gtfs_static/version={version}/" + table + ".parquet", keep)
        getattr(raw, table).groupBy("version").applyInArrow(write, "path string").count()
    write = _write_foreign(root, "gtfs_static/_versions.parquet", {"version": "string"})
    manifest = raw.versions.withColumn("day", F.left("valid_to", F.lit(0)))  # one group: one row an archive
    manifest.groupBy("day").applyInArrow(write, "path string").count()
    return root


def q_foreign_polls(spark, sf_dir):
    """Polls of another layout, their keys from the names of their files."""
    return Zone(spark, _foreign_zone(spark, sf_dir)).realtime("trip_updates")


def q_foreign_zone(spark, sf_dir):
    """A whole zone of another layout, up to the dashboard's first question."""
    return Marts.of(Warehouse(load_zone(spark, _foreign_zone(spark, sf_dir)))).punctuality_by_route()


def q_landing_to_marts(spark, sf_dir):
    """The product's path: land every raw table, build and store the marts from
    the landing zone, read them back, and ask the dashboard's first question."""
    root, out = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    raw = derived.load_derived(spark, sf_dir)
    sinks.append_manifest(raw.versions, root)
    for table in schemas.STATIC_TABLES:
        sinks.write_static(getattr(raw, table), root, table)
    for feed in ("trip_updates", "vehicle_positions"):
        sinks.write_realtime(getattr(raw, feed), root, feed, one_file_per_poll=True)
    write_marts(Warehouse(load_landing(spark, root)), out)
    return Marts.read(spark, out).punctuality_by_route()


# ── streaming ────────────────────────────────────────────────────────────────


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


#: Stop updates of one file of messages, about.
_FILE_UPDATES = 100_000


def _message_files(spark, sf_dir, at_least: int) -> int:
    """Files that all messages go to: none holds more when there are more messages."""
    return max(at_least, derived.updates_at_most(spark, sf_dir) // _FILE_UPDATES)


def q_stream_flatten(spark, sf_dir):
    """Nested messages land as files; an available-now stream flattens
    them into the partitioned poll layout."""
    landing, out = scratch_path(spark, "messages"), scratch_path(spark, "flat")
    msgs = flatten.nest_trip_updates(derived.trip_updates(spark, sf_dir).select(*_TU_FLAT))
    files = _message_files(spark, sf_dir, 8)
    with shuffles_removed(spark):
        msgs.repartition(files).write.option("compression", "zstd").parquet(landing)
    _await(
        rt.stream_flatten(
            spark, landing, "trip_updates", out, scratch_path(spark, "chk"),
            max_files_per_trigger=-(-files // 2), poll_seconds=derived.POLL_SECONDS,
        )
    )
    return spark.read.schema(schemas.TRIP_UPDATES_LANDED).parquet(out)


def first_delivery(polls: DataFrame) -> DataFrame:
    """Polls as first fetched: in some, delays are a minute off, some rows
    are missing and others belong to no trip."""
    wrong = F.left(F.md5(F.col("poll").cast("binary")), F.lit(1)) < "5"
    late = F.when(wrong, F.col("arrival_delay") + 60).otherwise(F.col("arrival_delay"))
    kept = polls.withColumn("arrival_delay", late).where(~(wrong & (F.col("stop_sequence") % 4 == 1)))
    ghosts = polls.where(wrong & (F.col("stop_sequence") % 4 == 2)).withColumn("trip_id", F.concat(F.lit("ghost-"), "trip_id"))
    return kept.unionByName(ghosts)


def second_delivery(polls: DataFrame) -> DataFrame:
    """The wrong polls again, corrected."""
    return polls.where(F.left(F.md5(F.col("poll").cast("binary")), F.lit(1)) < "5")


def third_delivery(polls: DataFrame) -> DataFrame:
    """Some polls again as they were."""
    return polls.where(F.right(F.md5(F.col("poll").cast("binary")), F.lit(1)) < "4")


def _send(polls: DataFrame, delivery: int, to: str, files: int) -> None:
    messages = flatten.nest_trip_updates(polls.select(*_TU_FLAT))
    with shuffles_removed(polls.sparkSession):
        messages.repartition(files).write.option("compression", "zstd").parquet(f"{to}/delivery={delivery}")


def q_stream_poll_ledger(spark, sf_dir):
    """R1 where polls are sent again, corrected or repeated: the feed as last sent."""
    inbox, root = scratch_path(spark, "messages"), scratch_path(spark, "ledger")
    polls = derived.trip_updates(spark, sf_dir)
    files = _message_files(spark, sf_dir, 4)
    for number, deliver in enumerate((first_delivery, second_delivery, third_delivery), 1):
        _send(deliver(polls), number, inbox, files)
    per_batch = -(-5 * files // 4)  # three batches of the three deliveries' files
    _await(
        stream_polls(spark, inbox, "trip_updates", root, scratch_path(spark, "chk"), max_files_per_trigger=per_batch, poll_seconds=derived.POLL_SECONDS)
    )
    return PollLedger(spark, root, "trip_updates").read()


# The derived observations span years thinly (a few dozen per day), so the
# incremental tables are partitioned by month here; daily is the default.
_STREAM_GRANULARITY = "month"


def _land_for_stream(spark, sf_dir) -> tuple[str, int]:
    """Land every poll; return the landing path and a per-batch file limit
    giving about three micro-batches."""
    landing = scratch_path(spark, "landing")
    sinks.write_realtime(derived.trip_updates(spark, sf_dir), landing, "trip_updates", one_file_per_poll=True)
    path = f"{landing}/trip_updates"
    # a listing: no file is opened
    n_files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path").count()
    return path, max(1, n_files // 3 + 1)


def q_stream_latest_observation(spark, sf_dir):
    """R2: incremental newest observation per event over micro-batches."""
    landing, per_batch = _land_for_stream(spark, sf_dir)
    target = scratch_path(spark, "latest")
    _await(
        rt.stream_latest_observation(
            spark, landing, target, scratch_path(spark, "chk"), per_batch, granularity=_STREAM_GRANULARITY
        )
    )
    # Merge-on-read batches appended; compact once, then read the rows as stored.
    rt.compact_latest(spark, target, granularity=_STREAM_GRANULARITY)
    return rt.read_latest(spark, target, _STREAM_GRANULARITY, dedup=False).select(
        "service_date", "trip_id", "route_id", "direction_id", "stop_sequence", "stop_id",
        "vehicle_id", "vehicle_label", "arrival_delay", "departure_delay", "feed_timestamp",
    )


def q_incremental_fact(spark, sf_dir):
    """Fact partitions refreshed after every micro-batch for the service
    dates it touched; the result equals the batch fact."""
    # every batch joins the schedule
    wh = Warehouse(derived.load_derived(spark, sf_dir).store("stop_times"))
    landing, per_batch = _land_for_stream(spark, sf_dir)
    target, fact_dir = scratch_path(spark, "latest"), scratch_path(spark, "fact")

    def on_batch(touched):
        rt.refresh_fact(
            spark, target, wh.stg_gtfs_versions, wh.stg_stop_times, fact_dir, touched, _STREAM_GRANULARITY
        )

    _await(
        rt.stream_latest_observation(
            spark, landing, target, scratch_path(spark, "chk"), per_batch, on_batch, _STREAM_GRANULARITY
        )
    )
    return rt.read_fact(spark, fact_dir, _STREAM_GRANULARITY)


#: Service dates until which each round of the chronological stream below runs.
_ROUNDS = ("1996-12-31", "1998-12-31", "9999-12-31")


def _chronological(spark, sf_dir):
    """Rounds of updates whose feed times follow their service dates, and rows for dates long closed.

    A feed time is the service day's midnight plus the derived feed's offset, so
    the newest observation of an event is the same row as in the batch marts."""
    day = F.to_date(F.nullif(F.col("start_date"), F.lit("")), "yyyyMMdd")
    flat = derived.trip_updates(spark, sf_dir).select(*_TU_FLAT, day.alias("day")).where("day IS NOT NULL")
    offset = F.col("feed_timestamp") - derived.FEED_EPOCH_BASE
    spread = flat.agg(F.max(offset)).first()[0] or 0
    flat = flat.withColumn("feed_timestamp", offset + F.unix_date("day").cast("bigint") * 86400)
    landed = with_poll_partitions(flat, poll_seconds=30 * 86400).withColumn("delivery", F.lit(1).cast("long"))
    rounds, since = [], "0001-01-01"
    for until in _ROUNDS:
        rounds.append(landed.where(F.col("day").between(F.lit(since).cast("date"), F.lit(until).cast("date"))))
        since = str(dt.date.fromisoformat(until) + dt.timedelta(1)) if until < "9999" else until
    late = landed.where("day < DATE'1996-01-01' AND stop_sequence = 1")
    late = late.withColumns({"feed_timestamp": F.col("feed_timestamp") + 1, "poll": F.concat("poll", F.lit("late"))})
    return rounds, late, spread


def _stream_state(spark, sf_dir, rounds_apart: bool) -> str:
    """Rounds of polls (or all at once) and late rows through the ledger and the keyed state; the result's folder."""
    feed = PollLedger(spark, scratch_path(spark, "ledger"), "trip_updates")
    out, chk = scratch_path(spark, "state"), scratch_path(spark, "chk")
    rounds, late, spread = _chronological(spark, sf_dir)
    rounds = rounds if rounds_apart else [quality.union_all(rounds)]
    # a state partition for each 100,000 updates, a few at least
    parts = max(8, derived.trip_updates(spark, sf_dir).count() // 100_000)
    for epoch, rows in enumerate([*rounds, late]):
        feed.apply(rows, "rounds", epoch)
        _await(state.stream_latest_state(spark, f"{feed.root}/changes", out, chk, delay=f"{spread + 86400} seconds", grace_days=2, state_partitions=parts))
    return out


def q_stream_latest_state(spark, sf_dir):
    """R2 as keyed state: the newest observation of every event; rows for closed dates change nothing."""
    return state.read_winners(spark, _stream_state(spark, sf_dir, rounds_apart=True))


def q_stream_late_rows(spark, sf_dir):
    """R2: what came after its service date had closed."""
    return state.read_late(spark, _stream_state(spark, sf_dir, rounds_apart=False))


def _signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Winner changes between two tables of newest observations, one row an event at most in each."""

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select(*marts.EVENT_KEY, F.struct(*marts.OBS_ORDER).alias(name))

    both = side(before, "was").join(side(after, "now"), marts.EVENT_KEY, "full").where("NOT was <=> now")
    ends = F.array(F.struct(F.lit("-").alias("op"), F.col("was").alias("row")), F.struct(F.lit("+").alias("op"), F.col("now").alias("row")))
    changes = both.select(*marts.EVENT_KEY, F.explode(ends).alias("end")).where("end.row IS NOT NULL")
    return changes.select(*marts.EVENT_KEY, *(F.col(f"end.row.{c}").alias(c) for c in marts.OBS_ORDER), "end.op")


def _delta_batches(spark, sf_dir, report: bool = False) -> tuple[str, deltas.DelayCounts, DataFrame | None]:
    """The fact and its counts kept up through three batches of deltas: the feed as
    first delivered under the versions downloaded before 1998, then the whole
    manifest, then the corrections.  (fact folder, counts, with ``report`` what each batch did)"""
    # read by each batch: not derived again for every one
    raw = derived.load_derived(spark, sf_dir).store("stop_times", "trip_updates")
    wh, polls = Warehouse(raw), raw.trip_updates
    fact_dir, counts = scratch_path(spark, "fact"), deltas.DelayCounts(spark, scratch_path(spark, "counts"))
    first = stored(rt.reduce_latest(staging.stg_trip_updates(first_delivery(polls))), "first")
    right = rt.reduce_latest(wh.stg_trip_updates)
    whole, times = wh.stg_gtfs_versions, wh.stg_stop_times
    early = whole.where(F.col("downloaded_at") < "1998")
    steps = [
        lambda: deltas.winner_deltas(_signed(first.limit(0), first), early, times),
        lambda: deltas.manifest_deltas(first, early, whole, times),
        lambda: deltas.winner_deltas(_signed(first, right), whole, times),
    ]
    done = []
    for batch, step in enumerate(steps, 1):
        rows = stored(step(), "deltas")
        months = deltas.apply_deltas(spark, fact_dir, rows, _STREAM_GRANULARITY)
        counts.add(rows, batch)
        if report:
            did = deltas.delta_counts(rows)
            did = did.select(F.lit(batch).cast("long").alias("batch"), *did.columns, F.lit(months).cast("long").alias("touched_months"))
            done.append(stored(did, "did"))
        discard(rows)
    discard(first, polls, raw.stop_times)
    return fact_dir, counts, quality.union_all(done) if report else None


def q_delta_fact(spark, sf_dir):
    """The fact after deltas of observations, versions and corrections."""
    return rt.read_fact(spark, _delta_batches(spark, sf_dir)[0], _STREAM_GRANULARITY)


def q_delta_batches(spark, sf_dir):
    """What each batch of deltas inserted, updated and removed, and the partitions it touched."""
    return _delta_batches(spark, sf_dir, report=True)[2]


def q_maintained_by_route(spark, sf_dir):
    return _delta_batches(spark, sf_dir)[1].punctuality_by_route(_wh(spark, sf_dir).dim_routes)


def q_maintained_by_stop(spark, sf_dir):
    return _delta_batches(spark, sf_dir)[1].punctuality_by_stop(_wh(spark, sf_dir).dim_stops)


def q_maintained_by_hour(spark, sf_dir):
    return _delta_batches(spark, sf_dir)[1].punctuality_by_hour()


def q_maintained_distribution(spark, sf_dir):
    counts = _delta_batches(spark, sf_dir)[1]
    counts.compact()
    return counts.delay_distribution()


def q_maintained_total(spark, sf_dir):
    return _delta_batches(spark, sf_dir)[1].total_stop_events()


QUERIES: dict[str, Query] = {
    "stg_gtfs_versions": q_stg_gtfs_versions,
    "stg_stops": q_stg_stops,
    "stg_routes": q_stg_routes,
    "stg_trips": q_stg_trips,
    "stg_stop_times": q_stg_stop_times,
    "stg_calendar_dates": q_stg_calendar_dates,
    "stg_trip_updates": q_stg_trip_updates,
    "stg_vehicle_positions": q_stg_vehicle_positions,
    "gtfs_time_to_interval": q_gtfs_time_to_interval,
    "validity_window": q_validity_window,
    "version_dedup_anti": q_version_dedup_anti,
    "interval_join_days": q_interval_join_days,
    "interval_join_instants": q_interval_join_instants,
    "version_match_range": q_version_match_range,
    "latest_observation": q_latest_observation,
    "dim_stops": q_dim_stops,
    "dim_routes": q_dim_routes,
    "dim_trips": q_dim_trips,
    "fct_range": q_fct_range,
    "fct_stop_events": q_fct_stop_events,
    "punctuality_by_route": q_punctuality_by_route,
    "punctuality_by_hour": q_punctuality_by_hour,
    "punctuality_by_stop": q_punctuality_by_stop,
    "delay_distribution": q_delay_distribution,
    "total_stop_events": q_total_stop_events,
    "stops_with_coordinates": q_stops_with_coordinates,
    "punctuality_by_route_display": q_punctuality_by_route_display,
    "rt_freshness": q_rt_freshness,
    "rt_freshness_walk": q_rt_freshness_walk,
    "static_freshness": q_static_freshness,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_relationships": q_check_relationships,
    "check_delay_bounds": q_check_delay_bounds,
    "constraint_checks": q_constraint_checks,
    "mart_readiness": q_mart_readiness,
    "flatten_trip_updates": q_flatten_trip_updates,
    "flatten_vehicle_positions": q_flatten_vehicle_positions,
    "write_idempotent": q_write_idempotent,
    "publish_marts": q_publish_marts,
    "mirror_dataset": q_mirror_dataset,
    "static_round_trip": q_static_round_trip,
    "manifest_append": q_manifest_append,
    "ingest_realtime": q_ingest_realtime,
    "check_unique_staged": q_check_unique_staged,
    "check_orphan_positions": q_check_orphan_positions,
    "content_hash": q_content_hash,
    "archive_unpack": q_archive_unpack,
    "archive_skipped_tables": q_archive_skipped_tables,
    "archive_ingest": q_archive_ingest,
    "foreign_polls": q_foreign_polls,
    "foreign_zone": q_foreign_zone,
    "landing_to_marts": q_landing_to_marts,
    "stream_flatten": q_stream_flatten,
    "stream_poll_ledger": q_stream_poll_ledger,
    "stream_latest_observation": q_stream_latest_observation,
    "incremental_fact": q_incremental_fact,
    "stream_latest_state": q_stream_latest_state,
    "stream_late_rows": q_stream_late_rows,
    "delta_fact": q_delta_fact,
    "delta_batches": q_delta_batches,
    "maintained_by_route": q_maintained_by_route,
    "maintained_by_stop": q_maintained_by_stop,
    "maintained_by_hour": q_maintained_by_hour,
    "maintained_distribution": q_maintained_distribution,
    "maintained_total": q_maintained_total,
}

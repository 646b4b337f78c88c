"""Raw tables derived from the driver's TPC-H-style tables.

The driver supplies ``orders``, ``lineitem``, ``supplier``, ``nation`` and
``events`` at several scale factors.  This module maps them onto the raw
shapes of a schedule/realtime landing zone so every operator runs on data
whose volume grows with the scale factor:

* one schedule version per calendar quarter of ``o_orderdate``; version q
  covers the days from q to q + 4 months, so consecutive versions overlap;
* one realtime stop update per ``lineitem`` row (trip = order, stop
  sequence = line number), with duplicate (trip, sequence) keys exercising
  the latest-observation rule;
* the static tables of a version list the trips, stops and routes observed
  on the days it covers (data-driven equi-joins, never a cross product);
* vehicle positions come from ``events``.

The same mapping is written in SQL in ``headway.plans.oracle``; both must
stay expression-for-expression equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import checkpoint_root, stored
from headway.functions.dates import epoch_utc_date, epoch_utc_hour, poll_key, truncate_epoch, ymd

# Fixed values of the derived mapping (shared with the oracle SQL).
FEED_EPOCH_BASE = 1700000000
POSITION_EPOCH_BASE = 1704067200
DOWNLOAD_TIME = "T04:00:00"
VERSION_SPAN_MONTHS = 4
EMPTY_WINDOW_QUARTER = "1999-04-01"
N_ROUTES = 25
# The derived feeds are landed in hourly poll batches.
POLL_SECONDS = 3600
#: Lines whose listed keys one task holds at once, about.
TASK_LINES = 500_000


# Schemas of the driver's tables (only the columns used are read; passing
# them skips the schema-inference job on every read).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _read_columns(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    return _read(spark, sf_dir, name).select(*columns)


def _s(col: Column) -> Column:
    return col.cast("string")


def quarter_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schedule version per quarter present in ``orders``.

    Columns: q (DATE), version (full hash), gtfs_version (12-char prefix),
    downloaded_at, valid_from, valid_to, qm (month of q), qyear.
    At most four rows per calendar year of the DATE domain.
    """
    q = (
        _read(spark, sf_dir, "orders")
        .select(F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("q"))
        .distinct()
    )
    version = F.md5(_s(F.col("q")))
    return q.select(
        "q",
        version.alias("version"),
        F.substring(version, 1, 12).alias("gtfs_version"),
        F.concat(_s(F.col("q")), F.lit(DOWNLOAD_TIME)).alias("downloaded_at"),
        F.when(F.col("q") == F.lit(EMPTY_WINDOW_QUARTER).cast("date"), F.lit(""))
        .otherwise(ymd("q"))
        .alias("valid_from"),
        ymd(F.add_months("q", VERSION_SPAN_MONTHS)).alias("valid_to"),
        F.month("q").alias("qm"),
        F.year("q").alias("qyear"),
    )


def manifest(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    qv = qv if qv is not None else quarter_versions(spark, sf_dir)
    return qv.select(
        "version", "downloaded_at", "valid_from", "valid_to"
    )


def _orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )


def observed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order day (shuffle join on the order key)."""
    lines = _read_columns(
        spark,
        sf_dir,
        "lineitem",
        [
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_discount",
            "l_returnflag",
            "l_linestatus",
        ],
    )
    return lines.join(
        _orders_by_day(spark, sf_dir), lines.l_orderkey == F.col("o_orderkey")
    ).drop("o_orderkey")


def _covering_quarters(df: DataFrame) -> DataFrame:
    """Every quarter start ``q`` whose window [q, q + 4 months] covers ``day``."""
    q0 = F.trunc("day", "quarter")
    return df.withColumn("q", F.explode(F.array(q0, F.add_months(q0, -3)))).where(
        F.col("day") <= F.add_months("q", VERSION_SPAN_MONTHS)
    )


def _with_covering_versions(df: DataFrame, versions: DataFrame) -> DataFrame:
    """Attach every version whose window [q, q + 4 months] covers ``day``.

    Only the day's own quarter and the previous one can cover it, so the
    range condition becomes an equi-join on two candidate quarter starts;
    the version table holds at most four rows per year and is broadcast.
    """
    cand = _covering_quarters(df)
    v = versions.select("q", "gtfs_version", "qm", "qyear")
    return cand.join(F.broadcast(v), "q")


def updates_at_most(spark: SparkSession, sf_dir: str) -> int:
    """Rows of ``lineitem``: the updates, and those of orders that are not there."""
    return _read(spark, sf_dir, "lineitem").count()


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip-update observations with their poll partitions."""
    o = observed_lines(spark, sf_dir)
    qty = F.col("l_quantity").cast("int")
    feed_ts = (F.lit(FEED_EPOCH_BASE) + F.col("l_partkey") * 60 + F.col("l_suppkey")).cast("bigint")
    arrival = (
        F.when((F.col("l_returnflag") == "N") & (F.col("l_quantity") > 25), F.lit(None))
        .when(F.col("l_partkey") % 211 == 0, qty * 100)
        .otherwise(qty * 20 - 200)
        .cast("int")
    )
    departure = (
        F.when((F.col("l_returnflag") == "N") & (F.col("l_quantity") > 10), F.lit(None))
        .otherwise(qty * 18 - 150)
        .cast("int")
    )
    out = o.select(
        feed_ts.alias("feed_timestamp"),
        F.concat(_s(F.col("l_orderkey")), F.lit(":"), _s(F.col("l_partkey"))).alias("entity_id"),
        _s(F.col("l_orderkey")).alias("trip_id"),
        F.concat(F.lit("R"), _s(F.col("l_orderkey") % N_ROUTES)).alias("route_id"),
        (F.col("l_orderkey") % 2).cast("int").alias("direction_id"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("")).otherwise(ymd("day")).alias("start_date"),
        F.concat(F.lpad(_s(5 + F.col("l_orderkey") % 21), 2, "0"), F.lit(":00:00")).alias(
            "start_time"
        ),
        F.concat(F.lit("V"), _s(F.col("l_partkey") % 50)).alias("vehicle_id"),
        F.concat(F.lit("Vehicle "), _s(F.col("l_partkey") % 50)).alias("vehicle_label"),
        F.col("l_linenumber").cast("bigint").alias("stop_sequence"),
        F.concat(
            F.when(F.col("l_orderkey") % 89 == 0, F.lit("X")).otherwise(F.lit("S")),
            _s(F.col("l_suppkey")),
        ).alias("stop_id"),
        arrival.alias("arrival_delay"),
        (feed_ts + arrival).cast("bigint").alias("arrival_time"),
        departure.alias("departure_delay"),
        (feed_ts + departure).cast("bigint").alias("departure_time"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") >= 0.08), F.lit(1))
        .otherwise(F.lit(0))
        .alias("schedule_relationship"),
    )
    return out.select(
        "*",
        epoch_utc_date("feed_timestamp").alias("date"),
        epoch_utc_hour("feed_timestamp").alias("hour"),
        poll_key(truncate_epoch("feed_timestamp", POLL_SECONDS)).alias("poll"),
    )


def _scheduled_lines(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    """Observed lines with every version covering their day."""
    lines = _read_columns(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    o = lines.join(_orders_by_day(spark, sf_dir), lines.l_orderkey == F.col("o_orderkey")).drop(
        "o_orderkey"
    )
    return _with_covering_versions(o, qv if qv is not None else quarter_versions(spark, sf_dir))


def _listed(spark: SparkSession, sf_dir: str, qv: DataFrame | None, keys: list[str]) -> DataFrame:
    """Every (version, *keys) that schedules list, once: not every 23rd line.

    A version is a quarter start here, so the distinct runs on that date and the
    numeric keys, in tasks of a bounded number of lines: Spark sizes tasks by
    compressed bytes, of which a few hold very many keys."""
    versions = (qv if qv is not None else quarter_versions(spark, sf_dir)).select("q", "gtfs_version", "qm")
    lines = _read_columns(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    tasks = max(8, updates_at_most(spark, sf_dir) // TASK_LINES + 1)
    o = lines.where((F.col("l_orderkey") + F.col("l_linenumber")) % 23 != 0).join(
        _orders_by_day(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")
    )
    listed = _covering_quarters(o).select("q", *keys).repartition(tasks, *keys).distinct()
    return listed.join(F.broadcast(versions), "q")


def stop_times(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    """Every listed (version, trip, sequence) once.  All text columns are
    functions of (version, order, line)."""
    s = _listed(spark, sf_dir, qv, ["l_orderkey", "l_linenumber"])
    hh = F.lpad(_s(5 + F.col("l_orderkey") % 21), 2, "0")
    base_min = F.col("l_linenumber") * 5 + F.col("qm")
    return s.select(
        _s(F.col("l_orderkey")).alias("trip_id"),
        F.concat(hh, F.lit(":"), F.lpad(_s(base_min % 60), 2, "0"), F.lit(":00")).alias(
            "arrival_time"
        ),
        F.concat(hh, F.lit(":"), F.lpad(_s((base_min + 1) % 60), 2, "0"), F.lit(":30")).alias(
            "departure_time"
        ),
        F.concat(F.lit("S"), _s(1 + (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 100)).alias(
            "stop_id"
        ),
        _s(F.col("l_linenumber")).alias("stop_sequence"),
        F.col("gtfs_version").alias("version"),
    )


def trips(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    s = _listed(spark, sf_dir, qv, ["l_orderkey"])
    return s.select(
        F.concat(F.lit("R"), _s(F.col("l_orderkey") % N_ROUTES)).alias("route_id"),
        _s(F.col("l_orderkey") % 4).alias("service_id"),
        _s(F.col("l_orderkey")).alias("trip_id"),
        _s(F.col("l_orderkey") % 2).alias("direction_id"),
        F.col("gtfs_version").alias("version"),
    )


def stops(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    served = _scheduled_lines(spark, sf_dir, qv).select("gtfs_version", "qm", "qyear", "l_suppkey").distinct()
    sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    s = served.join(sup, served.l_suppkey == sup.s_suppkey).where(
        (F.col("s_suppkey") + F.col("qyear")) % 9 != 0
    )
    k = F.col("s_suppkey") % 1000
    return s.select(
        F.concat(F.lit("S"), _s(F.col("s_suppkey"))).alias("stop_id"),
        F.when(F.col("s_suppkey") % 41 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("s_name"), F.lit(" "), _s(F.col("qm"))))
        .alias("stop_name"),
        F.concat(F.lit("45."), F.lpad(_s(3000 + k), 4, "0")).alias("stop_lat"),
        F.when(F.col("s_suppkey") % 50 == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("11."), F.lpad(_s(8000 + k), 4, "0")))
        .alias("stop_lon"),
        F.col("gtfs_version").alias("version"),
    )


def routes(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    od = _orders_by_day(spark, sf_dir)
    served = (
        _with_covering_versions(od, qv if qv is not None else quarter_versions(spark, sf_dir))
        .select("gtfs_version", "qyear", (F.col("o_orderkey") % N_ROUTES).alias("rk"))
        .distinct()
    )
    nat = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = served.join(nat, served.rk == nat.n_nationkey).where(
        (F.col("n_nationkey") + F.col("qyear")) % 6 != 0
    )
    return r.select(
        F.concat(F.lit("R"), _s(F.col("n_nationkey"))).alias("route_id"),
        F.concat(F.col("n_name"), F.lit("-"), _s(F.col("qyear"))).alias("route_short_name"),
        _s(F.col("n_regionkey")).alias("route_type"),
        F.col("gtfs_version").alias("version"),
    )


def calendar_dates(spark: SparkSession, sf_dir: str, qv: DataFrame | None = None) -> DataFrame:
    od = _orders_by_day(spark, sf_dir)
    c = _with_covering_versions(od, qv if qv is not None else quarter_versions(spark, sf_dir))
    c = c.select("gtfs_version", (F.col("o_orderkey") % 4).alias("sid"), "day").distinct()
    return c.select(
        _s(F.col("sid")).alias("service_id"),
        ymd("day").alias("date"),
        F.lit("1").alias("exception_type"),
        F.col("gtfs_version").alias("version"),
    )


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    feed_ts = (F.lit(POSITION_EPOCH_BASE) + F.col("event_id") * 60).cast("bigint")
    uid = F.col("user_id")
    out = e.select(
        feed_ts.alias("feed_timestamp"),
        _s(F.col("event_id")).alias("entity_id"),
        F.concat(F.lit("T"), _s(uid % 50)).alias("trip_id"),
        F.concat(F.lit("R"), _s(uid % N_ROUTES)).alias("route_id"),
        (uid % 2).cast("int").alias("direction_id"),
        ymd(F.col("ts").cast("date")).alias("start_date"),
        F.lit("").alias("start_time"),
        _s(uid).alias("vehicle_id"),
        F.concat(F.lit("Vehicle "), _s(uid)).alias("vehicle_label"),
        (F.lit(45.3) + (uid % 100).cast("double") / F.lit(1000.0)).alias("latitude"),
        (F.lit(11.8) + (uid % 37).cast("double") / F.lit(1000.0)).alias("longitude"),
        ((F.col("event_id") * 7) % 360).cast("float").alias("bearing"),
        F.col("value").cast("float").alias("speed"),
        (F.col("event_id") % 30).cast("bigint").alias("current_stop_sequence"),
        F.concat(F.lit("S"), _s(1 + F.col("event_id") % 100)).alias("stop_id"),
        (F.col("event_id") % 3).cast("int").alias("current_status"),
        F.when(F.col("event_type") == "error", F.lit(0).cast("bigint"))
        .otherwise(feed_ts)
        .alias("timestamp"),
    )
    return out.select(
        "*",
        epoch_utc_date("feed_timestamp").alias("date"),
        epoch_utc_hour("feed_timestamp").alias("hour"),
        poll_key(truncate_epoch("feed_timestamp", POLL_SECONDS)).alias("poll"),
    )


class DerivedTables:
    """Lazily derived raw tables of one scale-factor directory.

    Each table is built on first use; input reads and the quarter-version
    table are shared, so one plan scans each driver table through a single
    relation (and Spark can reuse identical exchanges)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._qv: DataFrame | None = None

    @property
    def quarters(self) -> DataFrame:
        """The quarter-version table, materialised once in the checkpoint
        directory (at most four rows per year), so downstream predicates run
        on those rows rather than being pushed into the ``orders`` scan."""
        if self._qv is None:
            checkpoint_root(self.spark)
            self._qv = quarter_versions(self.spark, self.sf_dir).checkpoint(eager=True)
        return self._qv

    def _get(self, name: str, build, needs_quarters: bool = True) -> DataFrame:
        if name not in self._cache:
            if needs_quarters:
                self._cache[name] = build(self.spark, self.sf_dir, self.quarters)
            else:
                self._cache[name] = build(self.spark, self.sf_dir)
        return self._cache[name]

    def store(self, *names: str) -> DerivedTables:
        """Write these tables to the shared scratch folder once, for queries that read them several times."""
        for name in names:
            self._cache[name] = stored(getattr(self, name), name)
        return self

    @property
    def versions(self) -> DataFrame:
        return self._get("versions", manifest)

    @property
    def stops(self) -> DataFrame:
        return self._get("stops", stops)

    @property
    def routes(self) -> DataFrame:
        return self._get("routes", routes)

    @property
    def trips(self) -> DataFrame:
        return self._get("trips", trips)

    @property
    def stop_times(self) -> DataFrame:
        return self._get("stop_times", stop_times)

    @property
    def calendar_dates(self) -> DataFrame:
        return self._get("calendar_dates", calendar_dates)

    @property
    def trip_updates(self) -> DataFrame:
        return self._get("trip_updates", trip_updates, needs_quarters=False)

    @property
    def vehicle_positions(self) -> DataFrame:
        return self._get("vehicle_positions", vehicle_positions, needs_quarters=False)


def load_derived(spark: SparkSession, sf_dir: str) -> DerivedTables:
    """All raw tables derived from one scale-factor directory (lazy)."""
    return DerivedTables(spark, sf_dir)

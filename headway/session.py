"""Session helpers: a tuned builder for local runs and a shared scratch root.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A private directory is set only when that
setting is missing and the master is local (tests and benches); any other
master is refused, because executors would not see the driver's folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults chosen for scale: AQE re-plans joins and coalesces partitions at
# runtime, skew join splits hot partitions, and the session time zone is UTC
# so zoned timestamps never depend on the machine.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "headway",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a session configured for this library."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.host"] = "127.0.0.1"
    conf["spark.driver.bindAddress"] = "127.0.0.1"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one if unset.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``; a
    temporary folder is used only where nothing is configured and the master is
    local, so that driver and executors are one process.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server owns the checkpoint dir
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must be set for this session") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="headway-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/headway-{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a job's shuffle files go as soon as the job ends.

    Otherwise they stay until the driver happens to collect its garbage.  For
    jobs whose result is stored: nothing that runs later reads their shuffles."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder, as compressed Parquet, and read back.

    Unlike an eager checkpoint it runs the job once and keeps no shuffle files."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            if "/headway-" in folder:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

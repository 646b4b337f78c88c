"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from headway.session import shuffles_removed


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local master gets a temporary folder (one
    process, so it is shared); any other master is refused, because a folder of
    the driver's machine would be invisible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="headway-llm-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared root."""
    return f"{shared_root(spark)}/headway-llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with a replicated or recoverable copy: an executor that
    is lost later costs only the tasks it was running.  The shuffle files of
    the write go when it ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing will read any more."""
    for table in tables:
        spark = table.sparkSession
        below = f"{shared_root(spark)}/headway-llm/".rpartition(":")[2].lstrip("/")
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            if below in folder:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(hadoop).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out

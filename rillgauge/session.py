"""Session at the edge, scratch space and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


_SCRATCH: list[str] = []


def get_session(app: str) -> SparkSession:
    """Session for a submitted job; memory and parallelism come from submit-time settings."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; all executors must share it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/rillgauge-{uuid.uuid4().hex}"
    _SCRATCH.append(folder)
    return f"{folder}/{name}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), held


def _remove(spark: SparkSession, folder: str) -> None:
    system, path = file_system(spark, folder)
    system.delete(path, True)


def release(spark: SparkSession) -> None:
    """Remove the scratch folders of this process; frames that read them must be done with."""
    while _SCRATCH:
        _remove(spark, _SCRATCH.pop())


def materialised(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Used before iterative training: later passes read a small table instead of
    repeating the scan, and a lost executor costs a re-read, not a recompute.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Remove a table that :func:`materialised` made and that no frame in use reads any more."""
    path = getattr(table, "_scratch", None)
    if path is None:
        return
    folder = path.rsplit("/", 1)[0]
    if folder in _SCRATCH:
        _SCRATCH.remove(folder)
        _remove(table.sparkSession, folder)

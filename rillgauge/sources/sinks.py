"""Sinks: partitioned Parquet, nested JSON, reports and lists."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgauge.session import file_system


def balanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of one output folder together in evenly sized tasks.

    The rebalance hint lets adaptive execution split a folder that holds a large
    share of all rows over several tasks and merge the tiny ones.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys])


FILE_BYTES = 512 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FILE_SIZE = Lock()  # the size of files is a setting of the session: one write at a time


def write_partitioned(
    df: DataFrame, path: str, keys: list[str], sort: list[str] | None = None, file_bytes: int = FILE_BYTES
) -> None:
    """Hive-partitioned Parquet; a re-run replaces exactly the folders it writes.

    Sorting inside each file by the columns queries filter on lets Parquet skip
    row groups. ``file_bytes`` of shuffled rows make a file, so that a large table does not become
    very many small ones; a folder with fewer is one file. The shuffled rows leave the disk when the write ends, not when
    the driver next collects its garbage.
    """
    conf = df.sparkSession.conf
    during = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes), CLEANUP: "true"}
    with _FILE_SIZE:
        before = {name: conf.get(name, None) for name in during}
        for name, value in during.items():
            conf.set(name, value)
        try:
            _write_partitioned(df, path, keys, sort)
        finally:
            for name, value in before.items():
                conf.unset(name) if value is None else conf.set(name, value)


def _write_partitioned(df: DataFrame, path: str, keys: list[str], sort: list[str] | None) -> None:
    (
        balanced(df, keys)
        .sortWithinPartitions(*keys, *(sort or []))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(path)
    )


STAGED, ACCEPTED, REPLACED = "_staged-", "_ACCEPTED", "_replaced"  # readers skip names that begin with a line


def publish_partitioned(
    df: DataFrame, path: str, keys: list[str], sort: list[str] | None = None, file_bytes: int = FILE_BYTES,
    accept: Callable[[], None] | None = None,
) -> None:
    """Like :func:`write_partitioned`, but the stored folders are replaced only once all is written and accepted.

    Rows are written to a folder beside the stored ones. ``accept`` is called when they are there and raises to refuse them,
    which leaves the table as it was. Then they are marked as accepted, and each folder is renamed into its place, the old one out of it. A run
    that is killed before the mark has changed nothing; one killed after it is carried to its end by the next
    publication, or by :func:`finish_publishing`. One publication into a table runs at a time.
    """
    spark = df.sparkSession
    finish_publishing(spark, path)
    staged = f"{path.rstrip('/')}/{STAGED}{uuid.uuid4().hex}"
    system, folder = file_system(spark, staged)
    try:
        write_partitioned(df, staged, keys, sort, file_bytes)
        if accept is not None:
            accept()
    except BaseException:
        system.delete(folder, True)
        raise
    system.create(_child(spark, staged, ACCEPTED), True).close()
    _put_in_place(spark, path, staged)


def finish_publishing(spark: SparkSession, path: str) -> None:
    """End what a killed run has left in a table: accepted folders go to their places, others go away."""
    system, folder = file_system(spark, path)
    if not system.exists(folder):
        return
    for name in [s.getPath().getName() for s in system.listStatus(folder)]:
        if name.startswith(STAGED):
            staged = f"{path.rstrip('/')}/{name}"
            if system.exists(_child(spark, staged, ACCEPTED)):
                _put_in_place(spark, path, staged)
            else:
                system.delete(_child(spark, staged), True)


def _child(spark: SparkSession, *names: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(names))


def _partition_folders(spark: SparkSession, root: str, below: str = "") -> Iterator[str]:
    """The innermost ``key=value`` folders, relative to the root."""
    system, _ = file_system(spark, root)
    names = [s.getPath().getName() for s in system.listStatus(_child(spark, f"{root}{below}")) if s.isDirectory()]
    inner = [f"{below}/{n}" for n in names if "=" in n and not n.startswith("_")]
    for folder in inner:
        yield from _partition_folders(spark, root, folder)
    if not inner and below:
        yield below


def _put_in_place(spark: SparkSession, path: str, staged: str) -> None:
    system, root = file_system(spark, staged)
    for folder in list(_partition_folders(spark, staged)):
        fresh, target = _child(spark, f"{staged}{folder}"), _child(spark, f"{path.rstrip('/')}{folder}")
        if system.exists(target):
            old = _child(spark, f"{staged}/{REPLACED}{folder}")
            system.mkdirs(old.getParent())
            if not system.rename(target, old):
                raise OSError(f"cannot move {target}")
        system.mkdirs(target.getParent())
        if not system.rename(fresh, target):
            raise OSError(f"cannot move {fresh}")
    system.delete(root, True)


def write_nested_json(df: DataFrame, path: str, keys: list[str]) -> None:
    """JSON lines under key folders, with the same overwrite rule."""
    (
        balanced(df, keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy(*keys)
        .json(path)
    )


SITE_KEYS, SITE_ORDER = ["cal_year", "state"], ["npdes", "pollutant"]


def write_sites(sites: DataFrame, path: str) -> None:
    """The site extract as a table by calendar year and state."""
    write_partitioned(sites, path, SITE_KEYS, SITE_ORDER)


def write_site_json(sites: DataFrame, path: str) -> None:
    write_nested_json(sites, path, ["label", "state"])


def write_pollutant_json(pollutants: DataFrame, path: str) -> None:
    write_nested_json(pollutants, path, ["year", "safe_name"])


def write_report(
    df: DataFrame, path: str, order: list[Column], limit: int | None = None, hidden: tuple[str, ...] = ()
) -> None:
    """Sorted CSV report with a header, replacing an earlier one.

    ``hidden`` columns only order the rows. Reports are small (top rows, sectors, or
    states by years), so adaptive execution leaves one sorted file; a report that
    outgrows that stays a sequence of sorted files instead of being forced through
    one task.
    """
    ordered = df.orderBy(*order)
    if limit is not None:
        ordered = ordered.limit(limit)
    ordered.drop(*hidden).write.mode("overwrite").option("header", True).csv(path)


def write_list(names: DataFrame, path: str) -> None:
    """One sorted name per line."""
    column = names.columns[0]
    names.select(F.col(column).alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_table_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Result table of one named run, kept apart from other runs by folder."""
    (
        df.withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )

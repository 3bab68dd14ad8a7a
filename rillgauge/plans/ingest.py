"""Ingest: raw CSV files to stored, partitioned tables."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rillgauge import schemas as S
from rillgauge.functions import clean
from rillgauge.sources import scans, sinks


def dmr_table(raw: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Measurement rows of a range of years with ``year``, ``state`` and ``cal_year``.

    A yearly file gives its label as the year. The consolidated early file is read
    once and each row takes the year its period ends in; rows outside the early
    part of the range are not stored.
    """
    early = F.col("label") == S.EARLY_LABEL
    ends_in = clean.year_suffix("MONITORING_PERIOD_END_DATE")
    last_early = min(end_year, S.FIRST_SINGLE_YEAR - 1)
    in_early_range = ends_in.cast("int").between(start_year, last_early)
    return (
        raw.filter(~early | in_early_range)
        .withColumns(
            {
                "cal_year": F.year(clean.to_period_date("MONITORING_PERIOD_END_DATE")),
                "year": F.when(early, ends_in).otherwise(F.col("label")),
                "state": clean.state_prefix("EXTERNAL_PERMIT_NMBR"),
            }
        )
        .select(*[f.name for f in S.DMR_TABLE.fields])
    )


def _with_numbers(raw: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return raw.withColumns({n: clean.to_number(n) for n in names})


def facility_table(raw: DataFrame) -> DataFrame:
    """Facilities with the state back-filled from the permit id; ``state_raw`` keeps the source."""
    return (
        _with_numbers(raw, S.FACILITY_NUMBERS)
        .withColumn("state", clean.backfilled_state("STATE_CODE", "NPDES_ID"))
        .withColumnRenamed("STATE_CODE", "state_raw")
        .select(*[f.name for f in S.FACILITY_TABLE.fields])
    )


def backfill_counts() -> list[Column]:
    """Rows read, rows with a blank state before the back-fill, and rows still blank."""
    blank = F.coalesce(F.trim("state_raw"), F.lit("")) == ""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(blank).alias("missing"),
        F.count_if(blank & F.col("state").isNotNull()).alias("fixed"),
        F.count_if(F.col("state").isNull()).alias("still_missing"),
    ]


def permit_table(raw: DataFrame) -> DataFrame:
    return (
        _with_numbers(raw, S.PERMIT_NUMBERS)
        .withColumn("PERMIT_TYPE_CODE", F.nullif(F.trim("PERMIT_TYPE_CODE"), F.lit("")))
        .select(*[f.name for f in S.PERMIT_TABLE.fields])
    )


def naics_table(raw: DataFrame) -> DataFrame:
    return raw.withColumn("state", clean.state_prefix("NPDES_ID"))


MAX_MALFORMED = 0.01  # share of the lines


class Counts:
    """Aggregates of a frame that a write of it gathers on the way.

    A write that turns out to have no rows may drop them with the rest of its plan; they are then worked out on their own.
    """

    def __init__(self, rows: DataFrame, *columns: Column):
        self.source, self.columns, self.seen = rows, columns, Observation()
        self.rows = rows.observe(self.seen, *columns)

    def get(self) -> dict[str, int]:
        try:
            return self.seen.get
        except Py4JJavaError:
            row = self.source.agg(*self.columns, F.count(self.source.columns[0]).alias("_read")).first().asDict()
            return {k: v for k, v in row.items() if k != "_read"}  # a scan has to read a field of its files


def well_formed(lines: DataFrame, max_malformed: float = MAX_MALFORMED) -> tuple[DataFrame, Callable[[], int]]:
    """The good records of a checked scan, and a function for after the write.

    It returns the number of malformed lines, which are left out, or raises when they are more than a share ``max_malformed``.
    """
    bad = F.col("malformed").isNotNull()

    def total(n: Column, name: str) -> Column:
        return F.coalesce(F.sum(n), F.lit(0)).alias(name)

    read = Counts(lines, total(F.col("n_lines"), "lines"), total(F.when(bad, F.col("n_lines")), "malformed"))

    def accepted() -> int:
        seen = read.get()
        if seen["malformed"] > max_malformed * seen["lines"]:
            raise ValueError(f"{seen['malformed']} of {seen['lines']} lines are malformed")
        return seen["malformed"]

    return read.rows.filter(~bad).drop("malformed", "n_lines"), accepted


def _published(
    lines: DataFrame, table_of: Callable[[DataFrame], DataFrame], output: str, keys: list[str], sort: list[str],
    max_malformed: float, *counts: Column,
) -> dict[str, int]:
    """Store the table of the good lines in place of the folders it has rows for; its counts, gathered during the write."""
    good, accepted = well_formed(lines, max_malformed)
    table = Counts(table_of(good), *(counts or [F.count(F.lit(1)).alias("rows")]))
    sinks.publish_partitioned(table.rows, output, keys, sort, accept=accepted)
    return {**table.get(), "malformed": accepted()}


def ingest_dmr(
    spark: SparkSession, input_dir: str, output: str, start_year: int, end_year: int, max_malformed: float = MAX_MALFORMED
) -> dict[str, int]:
    """Store a range of years; a re-run replaces them.

    Returns the rows written and the malformed lines, which are left out. More than a share
    ``max_malformed`` of the lines is an error, which leaves the stored table as it was.
    """
    present = scans.present_labels(
        spark, input_dir, scans.labels_for_years(start_year, end_year)
    )
    if not present:
        return {"rows": 0, "malformed": 0}
    return _published(
        scans.scan_dmr(spark, input_dir, present, checked=True), lambda good: dmr_table(good, start_year, end_year),
        output, ["year", "state"], ["PARAMETER_DESC", "EXTERNAL_PERMIT_NMBR"], max_malformed,
    )


def ingest_facilities(spark: SparkSession, path: str, output: str, max_malformed: float = MAX_MALFORMED) -> dict[str, int]:
    """Store the facilities; returns the back-fill counts and the malformed lines."""
    lines = scans.scan_facilities(spark, path, checked=True)
    return _published(lines, facility_table, output, ["state"], ["NPDES_ID"], max_malformed, *backfill_counts())


def ingest_permits(spark: SparkSession, path: str, output: str, max_malformed: float = MAX_MALFORMED) -> dict[str, int]:
    """Store the permits; returns the rows written and the malformed lines."""
    lines = scans.scan_permits(spark, path, checked=True)
    return _published(lines, permit_table, output, ["PERMIT_TYPE_CODE"], ["EXTERNAL_PERMIT_NMBR"], max_malformed)


def ingest_naics(spark: SparkSession, path: str, output: str, max_malformed: float = MAX_MALFORMED) -> dict[str, int]:
    """Store the industry codes; returns the rows written and the malformed lines."""
    return _published(scans.scan_naics(spark, path, checked=True), naics_table, output, ["state"], ["NPDES_ID"], max_malformed)

"""Scans: raw CSV files, stored Parquet tables, nested JSON extracts."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgauge import schemas as S
from rillgauge.functions import clean
from rillgauge.session import materialised
from rillgauge.sources import records

log = logging.getLogger(__name__)


# Fixed value: name pattern of the measurement files; a yearly one carries "FY".
LABEL_PATTERN = r"(?:^|/)NPDES_DMRS_(?:FY([0-9]{4})|(PREFY2009))\.csv(?:/|$)"


# How the files quote.
CSV = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "malformed"}


def _parsed(spark: SparkSession, paths: list[str], columns: Sequence[str], checked: bool) -> DataFrame:
    """Records of CSV files: the columns, ``malformed`` (the text of a record with another number of fields), ``n_lines``, ``path``, ``source_pos``.

    A first scan finds the files that hold line breaks inside quoted fields, see :mod:`records`; the others are read by
    Spark's own reader. Every file has a header. Fields are counted only if ``checked``: a pruned scan does not look at them all.
    """
    schema = S.text_schema([*columns, "malformed"])
    every = records.lines(spark, paths)
    splits = materialised(records.surveyed(every), "splits")
    broken = records.broken_files(splits)
    reader = spark.read.schema(schema).options(header=True, encoding="UTF-8", columnPruning=not checked, **CSV)
    rows = reader.csv(paths).select(
        "*", F.lit(1).cast("bigint").alias("n_lines"), F.col("_metadata.file_path").alias("path"), source_pos().alias("source_pos")
    )
    if not broken:
        return rows
    text = records.assembled(every.where(F.col("file").isin(broken)), splits.where(F.col("file").isin(broken)))
    fields = F.from_csv("text", ", ".join(f"`{f.name}` string" for f in schema.fields), CSV)
    place = F.struct(F.col("name").alias("file"), "block", "row")
    once = clean.once(
        fields.alias("f"), F.col("text"), F.col("stray"), F.col("n_lines"), F.col("file").alias("path"), place.alias("source_pos")
    )
    put = text.select(once).select(
        *[F.col(f"f.`{c}`").alias(c) for c in columns],
        F.when(F.col("stray"), F.col("text")).otherwise(F.col("f.malformed")).alias("malformed"), "n_lines", "path", "source_pos",
    )
    return rows.where(~F.col("path").isin(broken)).unionByName(put)


def source_pos() -> Column:
    """Position of a scanned row: file, split offset, running number in the split.

    File and offset come from the scan itself and order the rows of a file; the
    running number only has to order rows within one split.
    """
    return F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def file_label(path: Column) -> Column:
    """Label in a measurement path: ``PREFY2009`` or a fiscal year, NULL for other files."""
    found = F.concat(F.regexp_extract(path, LABEL_PATTERN, 1), F.regexp_extract(path, LABEL_PATTERN, 2))
    return F.nullif(found, F.lit(""))


def labels_for_years(start_year: int, end_year: int) -> list[str]:
    """Labels of the files that hold a range of years."""
    early = [S.EARLY_LABEL] if start_year < S.FIRST_SINGLE_YEAR else []
    return early + [str(y) for y in range(max(start_year, S.FIRST_SINGLE_YEAR), end_year + 1)]


def source_path(input_dir: str, label: str) -> str:
    """A label's source: one file, or a folder of part files with that name."""
    stem = label if label == S.EARLY_LABEL else f"FY{label}"
    return f"{input_dir.rstrip('/')}/NPDES_DMRS_{stem}.csv"


def present_labels(spark: SparkSession, input_dir: str, labels: list[str] | None = None) -> list[str]:
    """Requested labels that have a source; the others are reported and skipped.

    Without a request, every label that is there. A source is a file right in the folder with the
    exact name, or a folder of that name with files right in it. Lists names
    only, no content is read, and only the distinct labels come back.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(input_dir)
    label = file_label(F.col("path"))
    early = label == S.EARLY_LABEL
    name = F.concat(F.lit("NPDES_DMRS_"), F.when(early, label).otherwise(F.concat(F.lit("FY"), label)), F.lit(".csv"))
    parts = F.split("path", "/")
    at = F.array_position(parts, name).cast("int")
    folder = input_dir.rstrip("/").rsplit("/", 1)[-1]
    direct = (F.try_element_at(parts, at - 1) == folder) & (F.size(parts) - at <= 1)
    found = listing.where(label.isNotNull() & (at > 1)).where(direct).select(label.alias("label")).distinct()
    present = {row.label for row in found.collect()}
    if labels is None:
        return sorted(present, key=lambda x: (x != S.EARLY_LABEL, x))
    for label in labels:
        if label not in present:
            log.warning("no measurement file for %s, skipped", label)
    return [label for label in labels if label in present]


def _scan(spark: SparkSession, paths: list[str], columns: Sequence[str], checked: bool, *more: Column) -> DataFrame:
    """The fields of the records, ``more``, and if ``checked`` ``malformed`` and ``n_lines``."""
    names = [*columns, *(["malformed", "n_lines"] if checked else [])]
    return _parsed(spark, paths, columns, checked).select(*names, *more)


def scan_dmr(spark: SparkSession, input_dir: str, labels: list[str], checked: bool = False) -> DataFrame:
    """All requested measurement sources in one scan, with label and row position.

    ``checked`` adds ``malformed``, the text of a record with another number of fields or a stray quote, NULL for good ones, and
    ``n_lines``, the lines it was read from.
    """
    paths = [source_path(input_dir, label) for label in labels]
    return _scan(spark, paths, S.DMR_COLUMNS, checked, file_label(F.col("path")).alias("label"), F.col("source_pos"))


def scan_facilities(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    return _scan(spark, [path], S.FACILITY_COLUMNS, checked, F.col("source_pos"))


def scan_permits(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    return _scan(spark, [path], S.PERMIT_COLUMNS, checked)


def scan_naics(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    return _scan(spark, [path], S.NAICS_COLUMNS, checked)


def scan_ad_sites(spark: SparkSession, path: str) -> DataFrame:
    """Digester sites: latitude in the 12th column, longitude in the 13th."""
    return (
        _scan(spark, [path], [f"c{i}" for i in range(1, 14)], False)
        .select(
            clean.to_finite_text_number("c12").alias("lat"),
            clean.to_finite_text_number("c13").alias("lon"),
        )
        .dropna()
    )


def read_dmr(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.DMR_TABLE).parquet(path)


def read_facilities(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.FACILITY_TABLE).parquet(path)


def read_permits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PERMIT_TABLE).parquet(path)


def read_naics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.NAICS_TABLE).parquet(path)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Stored site extract; filters on ``cal_year`` and ``state`` choose folders."""
    return spark.read.schema(S.SITE_RECORD).parquet(path)


def pollutant_folders(spark: SparkSession, path: str) -> DataFrame:
    """``year`` and ``safe_name`` of the stored pollutant folders, from a listing; no content is read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)

    def named(key: str) -> Column:
        text = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    return listing.select(named("year").alias("year"), named("safe_name").alias("safe_name")).distinct()


def read_site_json(
    spark: SparkSession, path: str, label: str | None = None, states: list[str] | None = None
) -> DataFrame:
    """Site extract of one label or all, some states or all; absent ones add nothing."""
    df = spark.read.schema(S.SITE_RECORD).json(path)
    if label is not None:
        df = df.filter(F.col("label") == label)
    if states is not None:
        df = df.filter(F.col("state").isin(states))
    return df


def read_pollutant_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.POLLUTANT_RECORD).json(path)

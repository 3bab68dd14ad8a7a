"""Nested site records: measurements collected by site, split by year, filtered, sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillgauge.functions import clean
from rillgauge.operators.sizing import broadcast_if_small
from rillgauge.schemas import EARLY_LABEL
from rillgauge.session import materialised


def year_text(date_text: Column) -> Column:
    """Year of a valid period date as text, NULL for any other text."""
    return F.when(
        clean.to_period_date(date_text).isNotNull(),
        F.right(date_text, F.lit(4)).cast("int").cast("string"),
    )


CHUNK_ROWS = 4096  # consecutive rows of a split whose measurements are put together first, at most
RECORD_ROWS = 1_000_000  # measurements of a record, up to one chunk more


def _chunk(rows: DataFrame) -> Column:
    """Which ``CHUNK_ROWS`` rows of the source a position lies in; chunks are in the order of positions."""
    kind = rows.schema["pos"].dataType
    if isinstance(kind, T.StructType):
        *start, last = kind.names
        return F.struct(*[F.col(f"pos.{n}").alias(n) for n in start], F.floor(F.col(f"pos.{last}") / CHUNK_ROWS).alias(last))
    return F.floor(F.col("pos") / CHUNK_ROWS)


def nest_measurements(
    rows: DataFrame, keys: Sequence[str], carried: Sequence[str] = (), by_month: bool = False,
    record_rows: int = RECORD_ROWS,
) -> DataFrame:
    """One record per key and calendar year with its measurements in source order and its last unit.

    Input columns: the keys (not NULL), columns ``carried`` along that are constant
    within a key, ``date``, ``value``, ``unit`` and ``pos`` (source order: a whole number, or a struct that ends with one).

    Every key is cut by ``cal_year``, and ``by_month`` cuts further; ``part`` is then the month, else 0. First the measurements
    of each key are counted, without their values; a key year with more than ``record_rows`` measurements becomes several
    records, cut between chunks of the source, with 100, 200 and so on added to ``part``; so a key with a third of all rows is
    dealt over tasks, and no record is larger for being collected in one. Then the measurements are shuffled once into records.
    """
    month = F.month(clean.to_period_date("date")).cast("bigint")
    cut = [*keys, "cal_year", "part"]
    entry = F.struct("pos", "date", "value", "unit")
    dated = rows.withColumns(
        {"cal_year": year_text(F.col("date")), "part": month if by_month else F.lit(0).cast("bigint"), "chunk": _chunk(rows)}
    )
    # Counts only: a few bytes a key, and a few for each chunk of a large key; the values stay where they are read.
    sizes = dated.groupBy(*cut).agg(F.count(F.lit(1)).alias("all"))
    large = materialised(sizes.where(F.col("all") > record_rows).drop("all"), "large")
    counts = dated.join(broadcast_if_small(large), cut, "left_semi").groupBy(*cut, "chunk").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*cut).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    numbered = counts.select(*cut, "chunk", (100 * F.floor(before / record_rows)).alias("more"))
    placed = dated.join(broadcast_if_small(materialised(numbered, "numbered")), [*cut, "chunk"], "left").withColumn(
        "part", F.col("part") + F.coalesce("more", F.lit(0))
    )
    held = F.sort_array(F.collect_list(entry))
    return (
        placed.groupBy(*cut)
        .agg(*[F.max(c).alias(c) for c in carried], held.alias("entries"))
        .select(
            *keys,
            *carried,
            "cal_year",
            "part",
            F.element_at("entries", -1)["unit"].alias("unit"),
            F.transform(
                "entries", lambda e: F.struct(e["date"].alias("date"), e["value"].alias("value"))
            ).alias("measurements"),
        )
    )


def split_by_year(sites: DataFrame) -> DataFrame:
    """Site records by year and pollutant name.

    Records of a yearly label keep their label as the year; those of the consolidated early
    label take their calendar year and lose their unit. Row-wise, a few columns of each record.
    """
    early = F.col("label") == EARLY_LABEL
    return sites.select(
        "npdes", "pollutant", F.when(~early, F.col("unit")).alias("unit"), "lat", "lon", "cal_year", "part",
        "measurements", F.when(early, F.col("cal_year")).otherwise(F.col("label")).alias("year"),
        clean.safe_name("pollutant").alias("safe_name"),
    )


def measurements_of_year(sites: DataFrame, year: str) -> DataFrame:
    """Records with the measurements dated in a year."""
    return sites.filter(F.col("cal_year") == year)


def one_per_site(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records of the same site put together: measurements in the order of labels and parts, the last unit."""
    held = F.sort_array(F.collect_list(F.struct("label", "part", "unit", "measurements")))
    return (
        records.groupBy(*keys)
        .agg(held.alias("held"), F.max(F.struct("lat", "lon")).alias("place"))
        .select(
            *keys,
            "place.*",
            F.element_at("held", -1)["unit"].alias("unit"),
            F.flatten(F.col("held.measurements")).alias("measurements"),
        )
    )


def sorted_measurements(measurements: str = "measurements") -> Column:
    """Measurements in date order (ties in source order), with the value as a number."""
    keyed = F.transform(
        measurements,
        lambda m, i: F.struct(
            clean.to_period_date(m["date"]).alias("day"),
            i.alias("i"),
            m["date"].alias("date"),
            clean.to_number(m["value"]).alias("value"),
        ),
    )
    return F.transform(
        F.sort_array(keyed),
        lambda e: F.struct(e["date"].alias("date"), e["value"].alias("value")),
    )

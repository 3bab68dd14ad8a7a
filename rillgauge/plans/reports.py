"""Load reports: by facility, by industry sector, by state and year, top facilities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgauge.operators import paired
from rillgauge.operators.paired import Pairing

# Sort orders and row limits of the written reports.
HOTSPOT_ROWS = 200
PREVIEW_ROWS = 50


def hotspots(
    dmr: DataFrame, facilities: DataFrame, year: str, p: Pairing = Pairing(),
) -> DataFrame:
    """Average daily load and pair count of each facility in a year."""
    by_permit = paired.roll_up(
        paired.paired_totals(dmr.filter(F.col("year") == year), p), [p.entity]
    )
    return by_permit.join(
        facilities.select("NPDES_ID", "FACILITY_NAME", "CITY", "state"),
        F.col(p.entity) == F.col("NPDES_ID"),
    ).select(
        "FACILITY_NAME",
        "CITY",
        "state",
        F.round("load_mean", 2).alias("average_daily_nitrogen_load_kg"),
        F.col("pairs").alias("num_paired_measurements"),
        F.col("load_mean").alias("unrounded_load"),
        F.col("NPDES_ID").alias("permit"),
    )


def hotspots_order() -> list[Column]:
    """Unrounded mean first, permit id as the tie-break."""
    return [F.col("unrounded_load").desc(), F.col("permit")]


def hotspots_report(dmr: DataFrame, facilities: DataFrame, year: str, rows: int = HOTSPOT_ROWS) -> DataFrame:
    """Top facilities in report columns."""
    return (
        hotspots(dmr, facilities, year)
        .orderBy(*hotspots_order())
        .limit(rows)
        .drop("unrounded_load", "permit")
    )


def industry_load(
    dmr: DataFrame, naics: DataFrame, year: str, p: Pairing = Pairing(), primary_only: bool = False,
) -> DataFrame:
    """Total and average load of each industry sector in a year.

    A permit counts in each of its sectors; ``primary_only`` keeps its primary one.
    Readings without a value still count as pairs.
    """
    if primary_only:
        naics = naics.filter(F.col("PRIMARY_INDICATOR_FLAG") == "Y")
    sectors = permit_sectors(naics)
    by_permit = paired.roll_up(
        paired.paired_totals(dmr.filter(F.col("year") == year), p, reported_only=False),
        [p.entity],
    ).drop("load_mean")
    joined = by_permit.join(sectors, F.col(p.entity) == F.col("NPDES_ID"))
    return paired.roll_up(joined, ["NAICS_DESC"]).select(
        "NAICS_DESC",
        F.round("load_sum", 0).alias("total_annual_load_kg"),
        F.round("load_mean", 0).alias("avg_daily_load_per_report_kg"),
        F.col("pairs").alias("num_paired_measurements"),
    )


def industry_order() -> list[Column]:
    return [F.col("total_annual_load_kg").desc(), F.col("NAICS_DESC")]


def paired_rows(dmr: DataFrame, states: Sequence[str], p: Pairing = Pairing()) -> DataFrame:
    """The rows of both parameters in the states: what the regional series is made from."""
    return dmr.filter(F.col("state").isin(list(states)) & F.col(p.parameter).isin(p.n_param, p.f_param))


def regional_timeseries(dmr: DataFrame, states: Sequence[str], p: Pairing = Pairing()) -> DataFrame:
    """Total load and pair count by year and state."""
    totals = paired.paired_totals_by(
        dmr.filter(F.col("state").isin(list(states))), ["year", "state"], p
    )
    return paired.roll_up(totals, ["year", "state"]).select(
        "year",
        "state",
        F.round("load_sum", 0).alias("total_annual_load_kg"),
        F.col("pairs").alias("num_paired_measurements"),
    )


def regional_order() -> list[Column]:
    return [F.col("state"), F.col("year")]


def reporting_permits(permits: DataFrame, dmr: DataFrame) -> DataFrame:
    """Permit rows of the permits that report, before anything is computed from them."""
    return permits.join(dmr.select("EXTERNAL_PERMIT_NMBR"), "EXTERNAL_PERMIT_NMBR", "left_semi")


def distinct_permits(dmr: DataFrame) -> DataFrame:
    """The permits that report, each once."""
    return dmr.select("EXTERNAL_PERMIT_NMBR").distinct()


def permit_sectors(naics: DataFrame) -> DataFrame:
    """Each sector of each permit once."""
    return naics.select("NPDES_ID", "NAICS_DESC").distinct()


def top_facilities_by_load(
    dmr: DataFrame, permits: DataFrame, state: str | None, n_param: str, f_param: str, n: int,
) -> DataFrame:
    """The n permits of a state (or of all) with the largest undated mean load."""
    p = replace(Pairing(), n_param=n_param, f_param=f_param)
    rows = dmr if state is None else dmr.filter(F.col("state") == state)
    return (
        paired.undated_mean_load(rows, permits, p)
        .orderBy(F.col("mean_load").desc(), F.col(p.entity))
        .limit(n)
    )

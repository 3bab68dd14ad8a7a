"""Proximity match: sites within a box of any digester location."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.functions import geo
from rillgauge.schemas import PROXIMITY_DEGREES

SALTS = 64


def _with_cell(df: DataFrame, threshold: float) -> DataFrame:
    return df.withColumns(
        {
            "cell_lat": geo.grid_cell(F.col("lat"), threshold),
            "cell_lon": geo.grid_cell(F.col("lon"), threshold),
        }
    )


def _outline(points: DataFrame, group: list[str]) -> DataFrame:
    """Points of each group that no other point shields in all four directions."""
    eastward = Window.partitionBy(*group).orderBy("lon", "lat")
    westward = Window.partitionBy(*group).orderBy(F.desc("lon"), F.desc("lat"))
    keep = F.lit(False)
    for w in (eastward, westward):
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        low, high = F.min("lat").over(before), F.max("lat").over(before)
        keep = keep | low.isNull() | (F.col("lat") < low) | (F.col("lat") > high)
    return points.withColumn("keep", keep).filter("keep").drop("keep")


def cell_outlines(ad_sites: DataFrame, threshold: float = PROXIMITY_DEGREES) -> DataFrame:
    """The locations of each grid cell that can decide a match.

    The box around a site is twice a cell wide, so inside one cell it always
    reaches to a corner, an edge or everywhere. Whether it holds any location of
    the cell is therefore decided by those with nothing further out towards one
    of the four corners; the others can be left out without changing a result.
    A crowded cell shrinks to a few dozen points, first within salted shares of
    the cell, then over what the shares kept.
    """
    points = _with_cell(
        ad_sites.select("lat", "lon").filter(geo.usable(F.col("lat"), F.col("lon"))).distinct(),
        threshold,
    )
    cell = ["cell_lat", "cell_lon"]
    salted = points.withColumn("salt", F.pmod(F.xxhash64("lat", "lon"), F.lit(SALTS)))
    return _outline(_outline(salted, [*cell, "salt"]).drop("salt"), cell)


def matched_ids(
    sites: DataFrame, ad_sites: DataFrame, id_column: str = "npdes",
    threshold: float = PROXIMITY_DEGREES,
) -> DataFrame:
    """Distinct ids of sites with a digester location inside the box.

    The outline points are copied to their nine neighbouring cells and met by an
    equality join on the cell; the semi join stops at a site's first match.
    """
    offsets = F.sequence(F.lit(-1), F.lit(1))
    near = (
        cell_outlines(ad_sites, threshold)
        .withColumn("d_lat", F.explode(offsets))
        .withColumn("d_lon", F.explode(offsets))
        .select(
            (F.col("cell_lat") + F.col("d_lat")).alias("near_lat"),
            (F.col("cell_lon") + F.col("d_lon")).alias("near_lon"),
            F.col("lat").alias("ad_lat"),
            F.col("lon").alias("ad_lon"),
        )
    )
    located = _with_cell(
        sites.select(id_column, "lat", "lon")
        .filter(geo.usable(F.col("lat"), F.col("lon")))
        .distinct(),
        threshold,
    )
    inside = geo.within_box(
        F.col("lat"), F.col("lon"), F.col("ad_lat"), F.col("ad_lon"), threshold
    )
    same_cell = (F.col("cell_lat") == F.col("near_lat")) & (F.col("cell_lon") == F.col("near_lon"))
    return located.join(near, same_cell & inside, "left_semi").select(id_column).distinct()


MODES = ("all", "only", "exclude")


def keep_by_match(
    sites: DataFrame, matched: DataFrame, mode: str = "all", id_column: str = "npdes"
) -> DataFrame:
    """All sites, only matched ones, or only the others, by semi or anti join."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    if mode == "all":
        return sites
    return sites.join(matched, id_column, "left_semi" if mode == "only" else "left_anti")


def keep_flagged(flagged: DataFrame, mode: str = "all") -> DataFrame:
    """The same choice over sites that already carry ``is_ad``."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    if mode == "all":
        return flagged
    return flagged.filter(F.col("is_ad") if mode == "only" else ~F.col("is_ad"))


def with_match_flag(sites: DataFrame, matched: DataFrame, id_column: str = "npdes") -> DataFrame:
    """Class of each site: digester or other."""
    flagged = matched.select(id_column, F.lit(True).alias("is_ad"))
    return sites.join(flagged, id_column, "left").withColumn(
        "is_ad", F.coalesce("is_ad", F.lit(False))
    ).withColumn(
        "site_class",
        F.when(F.col("is_ad"), F.lit("Anaerobic Digestion")).otherwise(F.lit("Other Facility")),
    )

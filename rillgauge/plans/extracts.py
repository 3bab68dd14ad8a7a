"""Nested extracts for the map: by site, by pollutant, the name catalogue, one view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgauge import schemas as S
from rillgauge.functions import clean, geo
from rillgauge.operators import nested, proximity
from rillgauge.operators.sizing import broadcast_if_small
from rillgauge.plans import ingest
from rillgauge.session import materialised
from rillgauge.sources import sinks


def facility_lookup(raw_facilities: DataFrame) -> DataFrame:
    """Location of each facility: the last row with id, state and both coordinates."""
    fields = raw_facilities.select(
        clean.once(
            clean.blank_to_null("NPDES_ID").alias("npdes"),
            clean.to_finite_text_number(clean.trimmed("GEOCODE_LATITUDE")).alias("lat"),
            clean.to_finite_text_number(clean.trimmed("GEOCODE_LONGITUDE")).alias("lon"),
            clean.blank_to_null("STATE_CODE").alias("state"),
            F.col("source_pos"),
        )
    )
    return (
        fields.dropna(subset=["npdes", "lat", "lon", "state"])
        .groupBy("npdes")
        .agg(F.max_by(F.struct("lat", "lon", "state"), "source_pos").alias("place"))
        .select("npdes", "place.*")
    )


def valid_measurements(raw_dmr: DataFrame) -> DataFrame:
    """Rows with a value, no no-data code and a well-formed period date."""
    fields = raw_dmr.select(
        clean.once(
            F.col("label"),
            clean.trimmed("EXTERNAL_PERMIT_NMBR").alias("npdes"),
            F.coalesce(clean.trimmed("PARAMETER_DESC"), F.lit("")).alias("pollutant"),
            F.coalesce(clean.trimmed("DMR_UNIT_DESC"), F.lit("")).alias("unit"),
            clean.trimmed("MONITORING_PERIOD_END_DATE").alias("date"),
            clean.trimmed("DMR_VALUE_NMBR").alias("value"),
            clean.trimmed("NODI_CODE").alias("nodi"),
            F.col("source_pos").alias("pos"),
        )
    )
    return fields.filter(
        (F.coalesce("nodi", F.lit("")) == "")
        & (F.col("value") != "")
        & clean.to_period_date("date").isNotNull()
    ).select("label", "npdes", "pollutant", "unit", "date", "value", "pos")


def site_measurements(raw_dmr: DataFrame, raw_facilities: DataFrame, by_month: bool = False) -> DataFrame:
    """Nested records by label, state, site, pollutant and calendar year.

    The raw files are parsed once, and their valid rows, six short columns of the source's
    57, are shuffled once into records. The facility lookup, one short row per site, is broadcast
    when it measures small enough.
    """
    lookup = broadcast_if_small(materialised(facility_lookup(raw_facilities), "places"))
    rows = valid_measurements(raw_dmr).join(lookup, "npdes")
    keys = ["label", "state", "npdes", "pollutant"]
    return nested.nest_measurements(rows, keys, ["lat", "lon"], by_month).select(
        *[f.name for f in S.SITE_RECORD.fields]
    )


def store_sites(
    raw_dmr: DataFrame, raw_facilities: DataFrame, path: str, by_month: bool = False,
    max_malformed: float = ingest.MAX_MALFORMED,
) -> dict[str, int]:
    """Store the site extract of two checked scans; returns the malformed lines of either, which are left out.

    More than a share ``max_malformed`` of a source's lines is an error that leaves the stored extract as it was.
    """
    dmr, dmr_accepted = ingest.well_formed(raw_dmr, max_malformed)
    facilities, facilities_accepted = ingest.well_formed(raw_facilities, max_malformed)
    counts = {}

    def accept() -> None:
        counts.update(malformed=dmr_accepted(), malformed_facilities=facilities_accepted())

    sites = site_measurements(dmr, facilities, by_month)
    sinks.publish_partitioned(sites, path, sinks.SITE_KEYS, sinks.SITE_ORDER, accept=accept)
    return counts


def pollutant_measurements(sites: DataFrame) -> DataFrame:
    """Nested records by year and pollutant."""
    return nested.split_by_year(sites)


def name_collisions(pollutants: DataFrame) -> DataFrame:
    """Pollutants that share their safe name with another one within a year, one per row."""
    names = pollutants.select("year", "safe_name", "pollutant").distinct()
    shared = names.groupBy("year", "safe_name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return names.join(shared, ["year", "safe_name"], "left_semi")


def pollutant_catalogue(pollutants: DataFrame) -> DataFrame:
    """File and display name of every pollutant, in file-name order."""
    filename = F.concat("safe_name", F.lit(".json")).alias("filename")
    return (
        pollutants.select(filename)
        .distinct()
        .withColumn("displayName", clean.display_name("filename"))
        .orderBy("filename")
    )


def pollutant_names(pollutants: DataFrame) -> DataFrame:
    """Distinct safe names under four-digit year folders, sorted."""
    return (
        pollutants.filter(F.col("year").rlike("^[0-9]{4}$"))
        .select(F.col("safe_name").alias("name"))
        .distinct()
        .orderBy("name")
    )


def catalogue_years(
    spark: SparkSession, first: int = S.CATALOGUE_FIRST_YEAR, last: int = S.CATALOGUE_LAST_YEAR
) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("string").alias("year"))


def catalogue_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(code,) for code in S.STATE_CODES], "state string")


def site_view(
    sites: DataFrame, ad_sites: DataFrame, year: str, state: str | None = None,
    pollutant: str | None = None, ad_mode: str = "all", label_only: bool = False,
) -> DataFrame:
    """What the map shows: one row per site and pollutant with its measurements of a year, classed by proximity.

    ``sites`` is the stored extract; its partitions are the calendar year and the state.
    ``pollutant`` is a safe or display name. ``label_only`` looks only at the file label of the
    year, missing measurements of that year kept under another label.
    """
    scope = nested.measurements_of_year(sites, year)
    if state is not None:
        scope = scope.filter(F.col("state") == state)
    if label_only:
        scope = scope.filter(F.col("label") == clean.label_of_year(F.lit(year)))
    matched = proximity.matched_ids(scope.select("npdes", "lat", "lon").distinct(), ad_sites)
    shown = scope
    if pollutant:
        shown = shown.filter(clean.safe_name("pollutant") == clean.safe_name(F.lit(pollutant)))
    whole = nested.one_per_site(shown, ["npdes", "pollutant", "state"])
    flagged = proximity.with_match_flag(whole, matched)
    return (
        proximity.keep_flagged(flagged, ad_mode)
        .withColumn("measurements", nested.sorted_measurements())
        .withColumn("on_map", geo.usable(F.col("lat"), F.col("lon")))
    )


def site_count(view: DataFrame) -> DataFrame:
    """Number of sites shown, one a row."""
    return view.agg(F.count(F.lit(1)).alias("sites"))

"""Nested site records, their split by year, the name catalogue and the proximity match."""

from __future__ import annotations

from pyspark.sql import functions as F

from analogues import tables as t
from analogues.case import Case
from rillgauge import schemas as S
from rillgauge.functions import clean
from rillgauge.operators import nested, proximity
from rillgauge.plans import extracts
from rillgauge.session import materialised, scratch_path
from rillgauge.sources import scans, sinks

EVENT_NAMES = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in t.EVENT_PARAMETERS.items()
) + " END"
FLAG_NAMES = "CASE l_returnflag " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in t.FLAG_PARAMETERS.items()
) + " END"


def _place(id_expr, state, key, owner):
    return f"""
  SELECT {id_expr} AS npdes, {state} AS state,
         CASE WHEN label % 2 = 0 THEN embedding[3] ELSE embedding[1] END::DOUBLE AS lat,
         CASE WHEN label % 2 = 0 THEN embedding[4] ELSE embedding[2] END::DOUBLE AS lon
  FROM embeddings JOIN {owner} ON vec_id = {key}"""


SUPPLIER_STATE = "lpad(s_nationkey::VARCHAR, 2, '0')"
SUPPLIER_ID = f"{SUPPLIER_STATE} || lpad(s_suppkey::VARCHAR, 7, '0')"
PLACES = f"""
event_places AS ({_place("c_custkey::VARCHAR", "lpad(c_nationkey::VARCHAR, 2, '0')", "c_custkey", "customer")}),
line_places AS ({_place(SUPPLIER_ID, SUPPLIER_STATE, "s_suppkey", "supplier")})"""

ROWS = f"""
{PLACES},
event_rows AS (
  SELECT '2024' AS label, npdes, state, lat, lon, {EVENT_NAMES} AS pollutant,
         CASE WHEN value < 50 THEN 'mg/L' ELSE 'ug/L' END AS unit,
         strftime(ts, '%m/%d/%Y') AS period, CAST(ts AS DATE) AS day,
         value::VARCHAR AS val, event_id AS pos
  FROM events JOIN event_places ON npdes = user_id::VARCHAR
  WHERE value <= 200),
line_rows AS (
  SELECT 'PREFY2009' AS label, npdes, state, lat, lon, {FLAG_NAMES} AS pollutant,
         CASE l_returnflag WHEN 'R' THEN 'MGD' ELSE 'mg/L' END AS unit,
         strftime(l_shipdate, '%m/%d/%Y') AS period, CAST(l_shipdate AS DATE) AS day,
         l_quantity::VARCHAR AS val, l_orderkey * 8 + l_linenumber AS pos
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN line_places ON npdes = {SUPPLIER_ID}
  WHERE l_discount < 0.09),
all_rows AS (SELECT * FROM event_rows UNION ALL SELECT * FROM line_rows)"""

LIST = "string_agg(period || '=' || val, ';' ORDER BY pos, period, val)"


def _listed(measurements="measurements"):
    entries = F.transform(measurements, lambda m: F.concat(m["date"], F.lit("="), m["value"].cast("string")))
    return F.array_join(entries, ";").alias("readings")


def event_sites(spark, sf_dir):
    return extracts.site_measurements(
        t.as_stored(t.dmr_from_events(spark, sf_dir)), t.raw_facilities(spark, sf_dir, "events")
    )


def line_sites(spark, sf_dir):
    return extracts.site_measurements(
        t.as_stored(t.dmr_from_lineitem(spark, sf_dir)), t.raw_facilities(spark, sf_dir, "lineitem")
    )


def all_sites(spark, sf_dir):
    return event_sites(spark, sf_dir).unionByName(line_sites(spark, sf_dir))


def sites_nested(spark, sf_dir):
    sites = event_sites(spark, sf_dir)
    return sites.select(
        "label", "state", "npdes", "pollutant", "unit",
        F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), _listed(),
    )


SITES_NESTED = f"""
WITH {ROWS}
SELECT label, state, npdes, pollutant, arg_max(unit, pos) AS unit,
       round(lat, 9) AS lat, round(lon, 9) AS lon, {LIST} AS readings
FROM event_rows GROUP BY label, state, npdes, pollutant, lat, lon
"""


def sites_in_parts(spark, sf_dir):
    """Records cut by month: readings in source order, the last unit of each."""
    dmr = t.as_stored(t.dmr_from_lineitem(spark, sf_dir))
    parts = extracts.site_measurements(dmr, t.raw_facilities(spark, sf_dir, "lineitem"), by_month=True)
    return parts.select("npdes", "pollutant", "cal_year", "part", "unit", _listed())


SITES_IN_PARTS = f"""
WITH {ROWS}
SELECT npdes, pollutant, year(day)::VARCHAR AS cal_year, month(day) AS part, arg_max(unit, pos) AS unit, {LIST} AS readings
FROM line_rows GROUP BY npdes, pollutant, year(day), month(day)
"""


def sites_sorted(spark, sf_dir):
    sites = event_sites(spark, sf_dir)
    return sites.select("npdes", "pollutant", _listed(nested.sorted_measurements()))


SITES_SORTED = f"""
WITH {ROWS}
SELECT npdes, pollutant, string_agg(period || '=' || val, ';' ORDER BY day, pos) AS readings
FROM event_rows GROUP BY npdes, pollutant
"""


def valid_rows(spark, sf_dir):
    rows = extracts.valid_measurements(t.as_stored(t.dmr_from_lineitem(spark, sf_dir)))
    return rows.groupBy("npdes", "pollutant", "unit").agg(F.count(F.lit(1)).alias("n"))


VALID_ROWS = f"""
SELECT {SUPPLIER_ID} AS npdes, {FLAG_NAMES} AS pollutant,
       CASE l_returnflag WHEN 'R' THEN 'MGD' ELSE 'mg/L' END AS unit, count(*) AS n
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_discount < 0.09 GROUP BY ALL
"""


def lookup(spark, sf_dir):
    places = extracts.facility_lookup(t.raw_facilities(spark, sf_dir, "events"))
    return places.select("npdes", "state", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


LOOKUP = f"""
WITH {PLACES}
SELECT npdes, state, round(lat, 9) AS lat, round(lon, 9) AS lon FROM event_places
"""


def by_year(spark, sf_dir):
    split = extracts.pollutant_measurements(all_sites(spark, sf_dir))
    return split.select("year", "safe_name", "npdes", "pollutant", "unit", _listed())


SAFE = "replace(replace(replace({0}, '/', '-'), ' ', '_'), ',', '')"
BY_YEAR = f"""
WITH {ROWS}
SELECT year(day)::VARCHAR AS year, {SAFE.format("pollutant")} AS safe_name, npdes, pollutant,
       CASE WHEN label <> 'PREFY2009' THEN arg_max(unit, pos) END AS unit, {LIST} AS readings
FROM all_rows GROUP BY label, year(day), npdes, pollutant
"""


def filtered(spark, sf_dir):
    kept = nested.measurements_of_year(line_sites(spark, sf_dir), "1998")
    return kept.select("npdes", "pollutant", _listed())


FILTERED = f"""
WITH {ROWS}
SELECT npdes, pollutant, {LIST} AS readings
FROM line_rows WHERE year(day) = 1998 GROUP BY npdes, pollutant
"""


def stored_sites(spark, sf_dir):
    """The extract as a stored table: a view reads it, it does not build it."""
    return materialised(all_sites(spark, sf_dir), "sites")


def _ad_sites(spark, sf_dir):
    return t.located_vectors(spark, sf_dir, 4, 5, "vec_id").select("lat", "lon")


AD_MATCH = """
EXISTS (SELECT 1 FROM embeddings a
        WHERE abs({lat} - a.embedding[5]::DOUBLE) < 0.01 AND abs({lon} - a.embedding[6]::DOUBLE) < 0.01
          AND {lat} <> 0 AND {lon} <> 0 AND a.embedding[5] <> 0 AND a.embedding[6] <> 0)"""


def _view(ad_mode):
    def build(spark, sf_dir):
        view = extracts.site_view(
            stored_sites(spark, sf_dir),
            _ad_sites(spark, sf_dir),
            "1998",
            pollutant="Nitrogen total [as N]",
            ad_mode=ad_mode,
        )
        return view.select("npdes", "state", "unit", "is_ad", "site_class", _listed())

    return build


def _view_sql(condition):
    return f"""
WITH {ROWS},
shown AS (
  SELECT npdes, state, lat, lon, arg_max(unit, pos) AS unit,
         string_agg(period || '=' || val, ';' ORDER BY day, pos, val) AS readings
  FROM all_rows
  WHERE pollutant = '{S.N_PARAM}' AND year(day) = 1998
  GROUP BY npdes, state, lat, lon),
flagged AS (SELECT *, {AD_MATCH.format(lat="lat", lon="lon")} AS is_ad FROM shown)
SELECT npdes, state, unit, is_ad,
       CASE WHEN is_ad THEN 'Anaerobic Digestion' ELSE 'Other Facility' END AS site_class, readings
FROM flagged WHERE {condition}
"""


def view_count(spark, sf_dir):
    view = extracts.site_view(stored_sites(spark, sf_dir), _ad_sites(spark, sf_dir), "1998")
    return extracts.site_count(view)


VIEW_COUNT = f"""
WITH {ROWS}
SELECT count(DISTINCT (npdes, pollutant)) AS sites FROM all_rows WHERE year(day) = 1998
"""


def two_label_sites(spark, sf_dir):
    """The readings of each site spread over the early label and that of the year, in a stored table."""
    dmr = t.as_stored(
        t.dmr_from_lineitem(spark, sf_dir).withColumn(
            "label", F.when(F.expr("source_pos.row % 16 >= 8"), F.lit("2012")).otherwise(F.lit(S.EARLY_LABEL))
        )
    )
    path = scratch_path(spark, "sites")
    sinks.write_sites(extracts.site_measurements(dmr, t.raw_facilities(spark, sf_dir, "lineitem")), path)
    return scans.read_sites(spark, path)


def _two_labels(year, **options):
    def build(spark, sf_dir):
        view = extracts.site_view(two_label_sites(spark, sf_dir), _ad_sites(spark, sf_dir), year, **options)
        return view.select("npdes", "pollutant", "state", _listed())

    return build


def _two_labels_sql(condition):
    """Readings of a day are in the order of labels, then of the source."""
    return f"""
WITH {ROWS},
labelled AS (SELECT *, CASE WHEN pos % 16 >= 8 THEN '2012' ELSE 'PREFY2009' END AS place FROM line_rows)
SELECT npdes, pollutant, state, string_agg(period || '=' || val, ';' ORDER BY day, place, pos) AS readings
FROM labelled WHERE {condition} GROUP BY npdes, pollutant, state
"""


def _matching(mode, threshold=S.PROXIMITY_DEGREES):
    def build(spark, sf_dir):
        sites = t.located_vectors(spark, sf_dir, 0, 1, "npdes")
        ads = t.located_vectors(spark, sf_dir, 2, 3, "npdes")
        matched = proximity.matched_ids(sites, ads, threshold=threshold)
        return proximity.keep_by_match(sites, matched, mode).select("npdes")

    return build


def flagged(spark, sf_dir):
    sites = t.located_vectors(spark, sf_dir, 0, 1, "npdes")
    matched = proximity.matched_ids(sites, t.located_vectors(spark, sf_dir, 2, 3, "npdes"))
    return proximity.with_match_flag(sites, matched).select("npdes", "is_ad", "site_class")


NEAR = """EXISTS (SELECT 1 FROM embeddings a
  WHERE abs(e.embedding[1]::DOUBLE - a.embedding[3]::DOUBLE) < 0.01
    AND abs(e.embedding[2]::DOUBLE - a.embedding[4]::DOUBLE) < 0.01)"""


def _part_names(spark, sf_dir):
    """One record per part row; sizes decide between two spellings, so names collide."""
    slash = F.when(F.col("p_size") % 2 == 0, F.lit("/")).otherwise(F.lit("-"))
    name = F.concat("p_type", F.lit(", "), "p_name", F.lit(" "), slash, F.lit(" "), "p_brand")
    parts = t.table(spark, sf_dir, "part").select(name.alias("pollutant"), F.lit("2020").alias("year"))
    return parts.withColumn("safe_name", clean.safe_name("pollutant"))


PART_NAMES = f"""
parts AS (
  SELECT p_type || ', ' || p_name || ' ' || CASE WHEN p_size % 2 = 0 THEN '/' ELSE '-' END
         || ' ' || p_brand AS pollutant FROM part),
named AS (SELECT pollutant, {SAFE.format("pollutant")} AS safe_name FROM parts)"""


def catalogue(spark, sf_dir):
    return extracts.pollutant_catalogue(_part_names(spark, sf_dir))


CATALOGUE = f"""
WITH {PART_NAMES}
SELECT DISTINCT safe_name || '.json' AS filename, replace(safe_name, '_', ' ') AS "displayName"
FROM named ORDER BY filename
"""


def names(spark, sf_dir):
    parts = _part_names(spark, sf_dir)
    lines = extracts.pollutant_measurements(line_sites(spark, sf_dir)).select("pollutant", "year", "safe_name")
    return extracts.pollutant_names(parts.unionByName(lines))


NAMES = f"""
WITH {PART_NAMES}, {ROWS.lstrip()}
SELECT safe_name AS name FROM named
UNION SELECT {SAFE.format("pollutant")} FROM line_rows
ORDER BY name
"""


def collisions(spark, sf_dir):
    return extracts.name_collisions(_part_names(spark, sf_dir))


COLLISIONS = f"""
WITH {PART_NAMES},
names AS (SELECT DISTINCT safe_name, pollutant FROM named)
SELECT '2020' AS year, safe_name, pollutant FROM names
WHERE safe_name IN (SELECT safe_name FROM names GROUP BY safe_name HAVING count(*) > 1)
"""

CASES = [
    Case("facility_lookup_last_valid", lookup, LOOKUP),
    Case("valid_measurements", valid_rows, VALID_ROWS),
    Case("nested_by_entity_type", sites_nested, SITES_NESTED),
    Case("nested_in_parts", sites_in_parts, SITES_IN_PARTS),
    Case("nested_sorted_by_date", sites_sorted, SITES_SORTED),
    Case("explode_by_year", by_year, BY_YEAR),
    Case("nested_filter", filtered, FILTERED),
    Case("site_view_all", _view("all"), _view_sql("TRUE")),
    Case("site_view_only_matched", _view("only"), _view_sql("is_ad")),
    Case("site_view_exclude_matched", _view("exclude"), _view_sql("NOT is_ad")),
    Case("site_view_count", view_count, VIEW_COUNT),
    Case("site_view_two_labels", _two_labels("1997"), _two_labels_sql("year(day) = 1997")),
    Case(
        "site_view_of_state", _two_labels("1997", state="03"), _two_labels_sql("year(day) = 1997 AND state = '03'")
    ),
    Case(
        "site_view_label_only", _two_labels("1997", label_only=True),
        _two_labels_sql("year(day) = 1997 AND place = 'PREFY2009'"),
    ),
    Case("proximity_semi", _matching("only"), f"SELECT vec_id AS npdes FROM embeddings e WHERE {NEAR}"),
    Case("proximity_anti", _matching("exclude"), f"SELECT vec_id AS npdes FROM embeddings e WHERE NOT {NEAR}"),
    Case(
        "proximity_wide", _matching("only", 0.015),
        f"SELECT vec_id AS npdes FROM embeddings e WHERE {NEAR.replace('0.01', '0.015')}",
    ),
    Case(
        "proximity_flag",
        flagged,
        f"""SELECT vec_id AS npdes, {NEAR} AS is_ad,
       CASE WHEN {NEAR} THEN 'Anaerobic Digestion' ELSE 'Other Facility' END AS site_class
FROM embeddings e""",
    ),
    Case("name_catalogue", catalogue, CATALOGUE),
    Case("name_list", names, NAMES),
    Case("name_collisions", collisions, COLLISIONS),
]

"""Load reports: paired by date (by key, facility, sector, state and year) and undated."""

from __future__ import annotations

from pyspark.sql import functions as F

from analogues import tables as t
from analogues.case import Case
from rillgauge import schemas as S
from rillgauge.operators import paired
from rillgauge.plans import reports

# Plain SQL of the readings: raw NULL from 300 up, "<1" (no number) below 1.
READINGS = """
readings AS (
  SELECT user_id::VARCHAR AS permit, event_type AS param, CAST(ts AS DATE) AS day,
         CASE WHEN value >= 1 AND value < 300 THEN value END AS v,
         value < 300 AS reported
  FROM events)
"""
READINGS_2024 = READINGS.replace("FROM events)", "FROM events WHERE day(ts) % 3 <> 0)")


def load_by_key(spark, sf_dir):
    totals = paired.paired_totals(t.dmr_from_events(spark, sf_dir))
    return totals.select(
        F.col("EXTERNAL_PERMIT_NMBR").alias("permit"),
        F.col("MONITORING_PERIOD_END_DATE").alias("period"),
        F.round("load_sum", 3).alias("load_sum"),
        "load_known",
        "pairs",
    )


LOAD_BY_KEY = f"""
WITH {READINGS}
SELECT n.permit, strftime(n.day, '%m/%d/%Y') AS period,
       round(sum(n.v * f.v * 3.78541), 3) AS load_sum,
       count(n.v * f.v) AS load_known, count(*) AS pairs
FROM readings n JOIN readings f ON n.permit = f.permit AND n.day = f.day
WHERE n.param = 'purchase' AND f.param = 'view' AND n.reported AND f.reported
GROUP BY n.permit, n.day
"""


def by_entity(spark, sf_dir):
    full = reports.hotspots(
        t.dmr_from_events(spark, sf_dir), t.facilities_from_customer(spark, sf_dir), "2024"
    )
    return full.drop("unrounded_load")


BY_ENTITY = f"""
WITH {READINGS_2024},
loads AS (
  SELECT n.permit, n.v * f.v * 3.78541 AS load
  FROM readings n JOIN readings f ON n.permit = f.permit AND n.day = f.day
  WHERE n.param = 'purchase' AND f.param = 'view' AND n.reported AND f.reported),
by_permit AS (SELECT permit, avg(load) AS mean, count(*) AS pairs FROM loads GROUP BY permit)
SELECT c_name AS "FACILITY_NAME", c_mktsegment AS "CITY", n_name AS state,
       round(mean, 2) AS average_daily_nitrogen_load_kg,
       pairs AS num_paired_measurements, permit
FROM by_permit JOIN customer ON permit = c_custkey::VARCHAR
JOIN nation ON c_nationkey = n_nationkey
"""


def top_entities(spark, sf_dir):
    return reports.hotspots_report(
        t.dmr_from_events(spark, sf_dir),
        t.facilities_from_customer(spark, sf_dir),
        "2024",
        rows=reports.HOTSPOT_ROWS,
    )


TOP_ENTITIES = (
    BY_ENTITY.replace(", permit\nFROM", "\nFROM") + " ORDER BY mean DESC, permit LIMIT 200"
)


def by_sector(spark, sf_dir):
    return reports.industry_load(
        t.dmr_from_events(spark, sf_dir), t.naics_from_customer(spark, sf_dir), "2024"
    )


BY_SECTOR = f"""
WITH {READINGS_2024},
sectors AS (
  SELECT DISTINCT c_custkey::VARCHAR AS permit, unnest([c_mktsegment, n_name]) AS sector
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT sector AS "NAICS_DESC",
       round(sum(n.v * f.v * 3.78541), 0) AS total_annual_load_kg,
       round(avg(n.v * f.v * 3.78541), 0) AS avg_daily_load_per_report_kg,
       count(*) AS num_paired_measurements
FROM readings n JOIN readings f ON n.permit = f.permit AND n.day = f.day
JOIN sectors ON sectors.permit = n.permit
WHERE n.param = 'purchase' AND f.param = 'view'
GROUP BY sector
"""


def by_primary_sector(spark, sf_dir):
    return reports.industry_load(
        t.dmr_from_events(spark, sf_dir),
        t.naics_from_customer(spark, sf_dir),
        "2024",
        primary_only=True,
    )


BY_PRIMARY_SECTOR = BY_SECTOR.replace("unnest([c_mktsegment, n_name])", "c_mktsegment")


def by_period_region(spark, sf_dir):
    states = [f"{i:02d}" for i in range(0, 25, 2)]
    return reports.regional_timeseries(t.dmr_from_lineitem(spark, sf_dir), states).orderBy(
        *reports.regional_order()
    )


BY_PERIOD_REGION = """
WITH readings AS (
  SELECT lpad(s_nationkey::VARCHAR, 2, '0') AS state, l_suppkey AS permit, l_shipdate AS day,
         l_returnflag AS param, l_quantity AS v
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT year(n.day)::VARCHAR AS year, n.state,
       round(sum(n.v * f.v * 3.78541), 0) AS total_annual_load_kg,
       count(*) AS num_paired_measurements
FROM readings n JOIN readings f ON n.permit = f.permit AND n.day = f.day
WHERE n.param = 'A' AND f.param = 'R' AND n.state::INTEGER % 2 = 0
GROUP BY ALL ORDER BY state, year
"""


def topn_undated(spark, sf_dir):
    top = reports.top_facilities_by_load(
        t.dmr_from_orders(spark, sf_dir),
        t.permits_from_customer(spark, sf_dir),
        None,
        S.N_PARAM,
        S.F_PARAM,
        100,
    )
    return top.select(
        F.col("EXTERNAL_PERMIT_NMBR").alias("permit"),
        F.round("mean_load", 0).alias("mean_load"),
        "flow_reported",
    )


UNDATED = """
WITH n AS (SELECT o_custkey AS k, o_totalprice AS v FROM orders WHERE o_orderpriority = '1-URGENT'),
f AS (SELECT o_custkey AS k, o_totalprice AS v FROM orders WHERE o_orderpriority = '2-HIGH'),
p AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer
      UNION ALL SELECT c_custkey, c_acctbal / 2 FROM customer),
merged AS (
  SELECT n.k, n.v AS conc, coalesce(f.v, p.v) AS flow, f.v IS NOT NULL AS flow_reported
  FROM n LEFT JOIN f ON n.k = f.k LEFT JOIN p ON n.k = p.k)
SELECT k::VARCHAR AS permit, round(avg(conc * flow * 3.78541), 0) AS mean_load, flow_reported
FROM merged WHERE conc IS NOT NULL AND flow IS NOT NULL
GROUP BY k, flow_reported
"""
TOPN_UNDATED = UNDATED + " ORDER BY avg(conc * flow) DESC, permit LIMIT 100"


def undated_means(spark, sf_dir):
    means = paired.undated_mean_load(
        t.dmr_from_orders(spark, sf_dir), t.permits_from_customer(spark, sf_dir)
    )
    return means.select(
        F.col("EXTERNAL_PERMIT_NMBR").alias("permit"),
        F.round("mean_load", 0).alias("mean_load"),
        "flow_reported",
    )


def distinct_sectors(spark, sf_dir):
    pairs = reports.permit_sectors(t.naics_from_customer(spark, sf_dir))
    return pairs.groupBy("NAICS_DESC").agg(F.count(F.lit(1)).alias("permits"))


DISTINCT_SECTORS = """
SELECT sector AS "NAICS_DESC", count(*) AS permits
FROM (SELECT DISTINCT c_custkey, unnest([c_mktsegment, n_name]) AS sector
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
GROUP BY sector
"""


def distinct_permits(spark, sf_dir):
    permits = reports.distinct_permits(t.dmr_from_orders(spark, sf_dir))
    return permits.withColumnRenamed("EXTERNAL_PERMIT_NMBR", "permit")


DISTINCT_PERMITS = "SELECT DISTINCT o_custkey::VARCHAR AS permit FROM orders"


def permits_of_reporters(spark, sf_dir):
    """Permit rows limited to permits that report, a semi join."""
    permits = t.permits_from_customer(spark, sf_dir)
    return reports.reporting_permits(permits, t.dmr_from_orders(spark, sf_dir)).select(
        F.col("EXTERNAL_PERMIT_NMBR").alias("permit"),
        F.round("ACTUAL_AVERAGE_FLOW_NMBR", 3).alias("flow"),
    )


PERMITS_OF_REPORTERS = """
SELECT c_custkey::VARCHAR AS permit, round(v, 3) AS flow
FROM (SELECT c_custkey, unnest([c_acctbal, c_acctbal / 2]) AS v FROM customer)
WHERE c_custkey IN (SELECT o_custkey FROM orders)
"""

CASES = [
    Case("paired_load_by_key", load_by_key, LOAD_BY_KEY),
    Case("paired_load_by_entity", by_entity, BY_ENTITY),
    Case("paired_load_top_entities", top_entities, TOP_ENTITIES),
    Case("paired_load_by_sector", by_sector, BY_SECTOR),
    Case("paired_load_by_primary_sector", by_primary_sector, BY_PRIMARY_SECTOR),
    Case("paired_load_by_period_region", by_period_region, BY_PERIOD_REGION),
    Case("topn_load_undated", topn_undated, TOPN_UNDATED),
    Case("undated_mean_load", undated_means, UNDATED),
    Case("distinct_sectors", distinct_sectors, DISTINCT_SECTORS),
    Case("distinct_permits", distinct_permits, DISTINCT_PERMITS),
    Case("permits_of_reporters", permits_of_reporters, PERMITS_OF_REPORTERS),
]

"""Sources and sinks end to end, the inspector, text parsing and the forecasts.

The round trips write derived files to a fresh folder under the shared checkpoint
directory, run the real scan or sink on them and report over what comes back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from analogues import loads, nesting
from analogues import tables as t
from analogues.case import Case
from rillgauge import schemas as S
from rillgauge.functions import clean
from rillgauge.operators import boosting
from rillgauge.operators import inspect as inspector
from rillgauge.operators import timeseries as ts
from rillgauge.plans import extracts, forecast, ingest, reports
from rillgauge.session import scratch_path
from rillgauge.sources import scans, sinks


CSV_RECORDS = 100_000  # of a source file; a compressed one is read by one task


def _as_csv(df, columns, path):
    """Write the frame in a source file's full column order, absent columns blank; compressed, as most fields are."""
    have = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    (
        df.select(*have).write.option("header", True).option("quoteAll", True).option("escape", '"')
        .option("compression", "gzip").option("maxRecordsPerFile", CSV_RECORDS).csv(path)
    )


def dmr_round_trip(spark, sf_dir):
    """CSV files of both kinds -> ingest, twice -> partitioned table -> counts."""
    folder, output = scratch_path(spark, "csv"), scratch_path(spark, "dmr")
    _as_csv(t.dmr_from_lineitem(spark, sf_dir), S.DMR_COLUMNS, scans.source_path(folder, S.EARLY_LABEL))
    _as_csv(t.dmr_from_events(spark, sf_dir), S.DMR_COLUMNS, scans.source_path(folder, "2024"))
    for _ in range(2):
        ingest.ingest_dmr(spark, folder, output, 1995, 2024)
    stored = scans.read_dmr(spark, output)
    return stored.groupBy("year", "state", "cal_year").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("DMR_VALUE_STANDARD_UNITS").alias("reported"),
        F.count(clean.to_number("DMR_VALUE_STANDARD_UNITS")).alias("numeric"),
    )


DMR_ROUND_TRIP = """
WITH line AS (
  SELECT year(l_shipdate) AS y, lpad(s_nationkey::VARCHAR, 2, '0') AS state,
         TRUE AS reported, TRUE AS is_number
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
event AS (
  SELECT 2024 AS y, left(user_id::VARCHAR, 2) AS state,
         value < 300 AS reported, value >= 1 AND value < 300 AS is_number FROM events)
SELECT y::VARCHAR AS year, state, y::INTEGER AS cal_year, count(*) AS n,
       count(*) FILTER (WHERE reported) AS reported, count(*) FILTER (WHERE is_number) AS numeric
FROM (SELECT * FROM line UNION ALL SELECT * FROM event) GROUP BY ALL
"""


def _raw_facility_rows(spark, sf_dir):
    """Customers as facility text; a negative balance loses the state, a low one the id."""
    blank = F.col("c_acctbal") < 0
    return t.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < -900, F.lit(None).cast("string"))
        .otherwise(t.permit_of("c_nationkey", "c_custkey"))
        .alias("NPDES_ID"),
        F.col("c_name").alias("FACILITY_NAME"),
        F.when(~blank, F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("STATE_CODE"),
        F.col("c_acctbal").cast("string").alias("GEOCODE_LATITUDE"),
        F.lit("not known").alias("GEOCODE_LONGITUDE"),
    )


RAW_FACILITIES = """
raw AS (
  SELECT CASE WHEN c_acctbal >= -900 THEN lpad(c_nationkey::VARCHAR, 2, '0') || lpad(c_custkey::VARCHAR, 7, '0') END AS id,
         CASE WHEN c_acctbal >= 0 THEN lpad(c_nationkey::VARCHAR, 2, '0') END AS state_raw,
         c_acctbal AS lat
  FROM customer),
filled AS (SELECT *, coalesce(state_raw, left(id, 2)) AS state FROM raw)
"""


def facilities_round_trip(spark, sf_dir):
    source, output = scratch_path(spark, "facilities.csv"), scratch_path(spark, "facilities")
    _as_csv(_raw_facility_rows(spark, sf_dir), S.FACILITY_COLUMNS, source)
    ingest.ingest_facilities(spark, source, output)
    stored = scans.read_facilities(spark, output)
    return stored.groupBy("state").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("state_raw").alias("with_source_state"),
        F.round(F.sum("GEOCODE_LATITUDE"), 2).alias("latitude_sum"),
        F.count("GEOCODE_LONGITUDE").alias("longitudes"),
    )


FACILITIES_ROUND_TRIP = f"""
WITH {RAW_FACILITIES}
SELECT state, count(*) AS n, count(state_raw) AS with_source_state,
       round(sum(lat), 2) AS latitude_sum, 0::BIGINT AS longitudes
FROM filled GROUP BY state
"""


def backfill_counts(spark, sf_dir):
    raw = _raw_facility_rows(spark, sf_dir)
    state = clean.backfilled_state("STATE_CODE", "NPDES_ID").alias("state")
    return raw.select(F.col("STATE_CODE").alias("state_raw"), state).agg(*ingest.backfill_counts())


BACKFILL_COUNTS = f"""
WITH {RAW_FACILITIES}
SELECT count(*) AS rows, count(*) FILTER (WHERE state_raw IS NULL) AS missing,
       count(*) FILTER (WHERE state_raw IS NULL AND state IS NOT NULL) AS fixed,
       count(*) FILTER (WHERE state IS NULL) AS still_missing
FROM filled
"""


def permits_round_trip(spark, sf_dir):
    source, output = scratch_path(spark, "permits.csv"), scratch_path(spark, "permits")
    permits = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("EXTERNAL_PERMIT_NMBR"),
        F.col("c_mktsegment").alias("PERMIT_TYPE_CODE"),
        F.col("c_acctbal").cast("string").alias("ACTUAL_AVERAGE_FLOW_NMBR"),
    )
    _as_csv(permits, S.PERMIT_COLUMNS, source)
    ingest.ingest_permits(spark, source, output)
    return scans.read_permits(spark, output).groupBy("PERMIT_TYPE_CODE").agg(
        F.count_distinct("EXTERNAL_PERMIT_NMBR").alias("permits"),
        F.round(F.sum("ACTUAL_AVERAGE_FLOW_NMBR"), 2).alias("flow_sum"),
    )


PERMITS_ROUND_TRIP = """
SELECT c_mktsegment AS "PERMIT_TYPE_CODE", count(*) AS permits, round(sum(c_acctbal), 2) AS flow_sum
FROM customer GROUP BY c_mktsegment
"""


def naics_round_trip(spark, sf_dir):
    source, output = scratch_path(spark, "naics.csv"), scratch_path(spark, "naics")
    naics = t.table(spark, sf_dir, "supplier").select(
        t.permit_of("s_nationkey", "s_suppkey").alias("NPDES_ID"),
        F.lit('Sewage, "treatment"').alias("NAICS_DESC"),
        F.lit("Y").alias("PRIMARY_INDICATOR_FLAG"),
    )
    _as_csv(naics, S.NAICS_COLUMNS, source)
    ingest.ingest_naics(spark, source, output)
    return scans.read_naics(spark, output).groupBy("state", "NAICS_DESC").agg(
        F.count(F.lit(1)).alias("n")
    )


NAICS_ROUND_TRIP = """
SELECT lpad(s_nationkey::VARCHAR, 2, '0') AS state, 'Sewage, "treatment"' AS "NAICS_DESC", count(*) AS n
FROM supplier GROUP BY s_nationkey
"""


def ad_sites_scan(spark, sf_dir):
    """Coordinates in the 12th and 13th column of a CSV, unusable ones dropped."""
    source = scratch_path(spark, "ad_sites.csv")
    vectors = t.located_vectors(spark, sf_dir, 0, 1, "vec_id").join(
        t.table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id"
    )
    fill = [F.lit('a, "b"').alias(f"x{i}") for i in range(11)]
    longitude = F.when(F.col("label") != 3, F.col("lon").cast("string")).otherwise(F.lit("none"))
    vectors.select(*fill, F.col("lat").cast("string"), longitude.alias("lon")).write.option(
        "header", True
    ).option("escape", '"').csv(source)
    return scans.scan_ad_sites(spark, source).select(
        F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon")
    )


AD_SITES_SCAN = """
SELECT round(embedding[1]::DOUBLE, 9) AS lat, round(embedding[2]::DOUBLE, 9) AS lon
FROM embeddings WHERE label <> 3
"""


def json_round_trip(spark, sf_dir):
    """Site extract -> JSON -> pollutant extract -> JSON -> sizes by year and name."""
    site_path, pollutant_path = scratch_path(spark, "sites"), scratch_path(spark, "pollutants")
    sinks.write_site_json(nesting.all_sites(spark, sf_dir), site_path)
    sites = scans.read_site_json(spark, site_path)
    sinks.write_pollutant_json(extracts.pollutant_measurements(sites), pollutant_path)
    stored = scans.read_pollutant_json(spark, pollutant_path)
    return stored.groupBy("year", "safe_name").agg(
        F.count_distinct("npdes").alias("sites"),
        F.sum(F.size("measurements")).alias("measurements"),
        F.count("unit").alias("with_unit"),
    )


JSON_ROUND_TRIP = f"""
WITH {nesting.ROWS}
SELECT year(day)::VARCHAR AS year, {nesting.SAFE.format("pollutant")} AS safe_name,
       count(DISTINCT npdes) AS sites, count(*) AS measurements,
       CASE WHEN label = '2024' THEN count(DISTINCT npdes) ELSE 0 END AS with_unit
FROM all_rows GROUP BY year(day), pollutant, label
"""


def report_round_trip(spark, sf_dir):
    """Sector report as one sorted CSV file, read back."""
    path = scratch_path(spark, "report")
    report = reports.industry_load(
        t.dmr_from_events(spark, sf_dir), t.naics_from_customer(spark, sf_dir), "2024"
    )
    sinks.write_report(report, path, reports.industry_order())
    return spark.read.schema(report.schema).option("header", True).csv(path)


def inspected(spark, sf_dir):
    return inspector.inspect(
        t.table(spark, sf_dir, "orders"),
        columns=["o_orderkey", "o_orderdate", "o_totalprice", "no_such_column"],
        filters=[
            ("o_orderstatus", "=", "F"),
            ("o_totalprice", ">=", "100000"),
            ("o_orderdate", "<", "2000-01-01"),
            ("o_orderpriority", "not in", ["5-LOW", "2-HIGH"]),
        ],
        rows=None,
    ).withColumn("o_orderdate", F.to_date("o_orderdate"))


INSPECTED = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_orderdate < DATE '2000-01-01'
  AND o_orderpriority NOT IN ('5-LOW', '2-HIGH')
"""


def parsed(spark, sf_dir):
    """Numbers and dates in five spellings each, some of them invalid."""
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    number = (
        F.when(F.col("o_orderpriority") == "1-URGENT", price)
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("<"), price))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit(" "), price, F.lit(" ")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(price, F.lit("d")))
    )
    date = (
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    orders = t.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        F.coalesce(clean.to_finite_text_number(number), F.lit(-1.0)).alias("number"),
        clean.to_period_date(date).alias("day"),
        clean.year_suffix(date).alias("year_text"),
    )


PARSED = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN o_totalprice ELSE -1.0 END::DOUBLE AS number,
       CASE WHEN o_orderstatus IN ('O', 'F') THEN CAST(o_orderdate AS DATE) END AS day,
       CASE WHEN o_orderstatus IN ('O', 'F') THEN year(o_orderdate)::VARCHAR END AS year_text
FROM orders
"""

def daily_model_rows(spark, sf_dir):
    """Feature rows and split of the daily forecast, before any fit."""
    table = forecast.daily_model_table(_daily_dmr(spark, sf_dir), S.N_PARAM)
    places = {name: 4 for name in ts.DAILY_FEATURES if name.startswith(("lag", "rolling"))}
    return table.select(
        "bucket", F.round("target", 4).alias("target"),
        *(F.round(n, places[n]).alias(n) if n in places else F.col(n) for n in ts.DAILY_FEATURES), "is_test",
    )


def _daily_dmr(spark, sf_dir):
    """Early readings as the forecast reads them; the value is a square root."""
    return t.dmr_from_lineitem(spark, sf_dir).withColumn(
        "DMR_VALUE_NMBR", F.sqrt(F.col("DMR_VALUE_NMBR").cast("double")).cast("string")
    )


DAILY_MODEL_ROWS = """
WITH daily AS (
  SELECT CAST(l_shipdate AS DATE) AS bucket, avg(sqrt(l_quantity)) AS value
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL),
spine AS (
  SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 DAY))::DATE AS bucket FROM daily),
filled AS (
  SELECT bucket, last_value(value IGNORE NULLS) OVER (
           ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM spine LEFT JOIN daily USING (bucket)),
featured AS (
  SELECT bucket, value AS target,
         lag(value, 1) OVER w AS lag_1,
         lag(value, 2) OVER w AS lag_2,
         lag(value, 3) OVER w AS lag_3,
         lag(value, 4) OVER w AS lag_4,
         lag(value, 5) OVER w AS lag_5,
         lag(value, 6) OVER w AS lag_6,
         lag(value, 7) OVER w AS lag_7,
         lag(value, 1) OVER w - lag(value, 2) OVER w AS lag_1_diff,
         avg(value) OVER (ORDER BY bucket ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3,
         avg(value) OVER (ORDER BY bucket ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_mean_7,
         stddev_samp(value) OVER (ORDER BY bucket ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_std_7,
         avg(value) OVER (ORDER BY bucket ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_mean_30,
         (isodow(bucket) - 1)::INTEGER AS day_of_week, weekofyear(bucket)::INTEGER AS week_of_year,
         month(bucket)::INTEGER AS month,
       row_number() OVER w AS rn,
         (dense_rank() OVER (
            ORDER BY month(bucket)::VARCHAR || '_' || (isodow(bucket) - 1)::VARCHAR) - 1)::INTEGER
           AS month_day_interaction
  FROM filled WINDOW w AS (ORDER BY bucket)),
complete AS (SELECT * FROM featured WHERE rn > 30)
SELECT bucket, round(target, 4) AS target,
       round(lag_1, 4) AS lag_1, round(lag_2, 4) AS lag_2, round(lag_3, 4) AS lag_3, round(lag_4, 4) AS lag_4,
       round(lag_5, 4) AS lag_5, round(lag_6, 4) AS lag_6, round(lag_7, 4) AS lag_7,
       round(rolling_mean_7, 4) AS rolling_mean_7, round(rolling_std_7, 4) AS rolling_std_7,
       round(rolling_mean_3, 4) AS rolling_mean_3,
       round(rolling_mean_30, 4) AS rolling_mean_30, round(lag_1_diff, 4) AS lag_1_diff,
       day_of_week, week_of_year, month, month_day_interaction,
       row_number() OVER (ORDER BY bucket) > floor(0.8::DOUBLE * count(*) OVER ()) AS is_test
FROM complete
"""


def _through_run(spark, table):
    """A result table as its stored run gives it back."""
    path = scratch_path(spark, "run")
    sinks.write_run(table, path, "check")
    return spark.read.parquet(path).where("run = 'check'")


def gbt_daily(spark, sf_dir):
    """Predicted days: the value as it was, and whether the prediction is what the stored trees give, followed node by node."""
    result = forecast.daily_forecast(_daily_dmr(spark, sf_dir), S.N_PARAM)
    scored, nodes = _through_run(spark, result.predictions), _through_run(spark, result.nodes)
    again = boosting.recomputed(scored, nodes, ts.DAILY_FEATURES, F.col("bucket"), forecast.DAILY.depth)
    near = F.abs(F.col("prediction") - F.col("recomputed")) <= 1e-9 * (1 + F.abs("recomputed"))
    return scored.join(again, scored["bucket"] == again["key"], "left").select(
        "series", "bucket", F.round("y_test", 4).alias("y_test"), F.coalesce(near, F.lit(False)).alias("follows_its_trees"),
    )


GBT_DAILY = f"""
SELECT '{S.N_PARAM}' AS series, bucket, target AS y_test, TRUE AS follows_its_trees
FROM ({DAILY_MODEL_ROWS}) WHERE is_test
"""


def gbt_facilities(spark, sf_dir):
    """Per series: test months, whether the stored errors are those of the stored predictions, importances those of the stored trees."""
    result = forecast.facility_forecasts(
        t.dmr_from_lineitem(spark, sf_dir), t.permits_from_customer(spark, sf_dir), None, S.N_PARAM, n=3
    )
    metrics = _through_run(spark, result.metrics).select("series", "n", "mae", "rmse", "rounds", "grown")
    error = F.col("y_test") - F.col("prediction")
    again = _through_run(spark, result.predictions).groupBy("series").agg(
        F.avg(F.abs(error)).alias("mae_again"), F.sqrt(F.avg(error * error)).alias("rmse_again")
    )
    shares = _through_run(spark, result.importance).groupBy("series").agg(
        F.sum("importance").alias("total"), F.sum("weight").alias("splits")
    )
    trees = _through_run(spark, result.nodes).groupBy("series").agg(
        F.count("feature").alias("splits_again"), F.max("tree").alias("trees")
    )

    def near(a, b):
        return F.abs(F.col(a) - F.col(b)) <= 1e-9 * (1 + F.abs(F.col(b)))

    stopped = (F.col("grown") == forecast.MONTHLY.rounds) | (F.col("grown") - F.col("rounds") == forecast.MONTHLY.patience)
    return metrics.join(again, "series").join(shares, "series").join(trees, "series").select(
        "series", F.col("n").alias("n_test"), (near("mae", "mae_again") & near("rmse", "rmse_again")).alias("errors_agree"),
        ((F.abs(F.col("total") - 1) < 1e-6) | (F.col("total") == 0)).alias("importance_adds_up"),
        ((F.col("splits") == F.col("splits_again")) & (F.col("trees") == F.col("rounds"))).alias("trees_agree"),
        stopped.alias("stopped_by_patience"),
    )


GBT_FACILITIES = """
WITH readings AS (
  SELECT lpad(s_nationkey::VARCHAR, 2, '0') || lpad(s_suppkey::VARCHAR, 7, '0') AS series, l_returnflag AS flag,
         l_quantity AS v, CAST(date_trunc('month', l_shipdate) AS DATE) AS month
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
top AS (
  SELECT series FROM readings GROUP BY series
  HAVING count_if(flag = 'A') > 0 AND count_if(flag = 'R') > 0
  ORDER BY avg(v) FILTER (flag = 'A') * avg(v) FILTER (flag = 'R') DESC, series LIMIT 3),
months AS (SELECT series, count(DISTINCT month) AS n FROM readings JOIN top USING (series) WHERE flag = 'A' GROUP BY series)
SELECT series, greatest(1, floor(0.2::DOUBLE * (n - 12)))::BIGINT AS n_test, TRUE AS errors_agree, TRUE AS importance_adds_up,
       TRUE AS trees_agree, TRUE AS stopped_by_patience
FROM months WHERE n >= 24
"""


def empty_report(spark, sf_dir):
    """A report over a year without readings is an empty table with its header, stored and read back."""
    path = scratch_path(spark, "report")
    report = reports.industry_load(t.dmr_from_events(spark, sf_dir), t.naics_from_customer(spark, sf_dir), "1900")
    sinks.write_report(report, path, reports.industry_order())
    return spark.read.schema(report.schema).option("header", True).csv(path)


def reports_by_year(spark, sf_dir):
    """A year with readings and one without, stored alike: each file's header, number of rows and total."""
    dmr, naics = t.dmr_from_events(spark, sf_dir), t.naics_from_customer(spark, sf_dir)
    found = None
    for year in ("1900", "2024"):
        path = scratch_path(spark, "report")
        sinks.write_report(reports.industry_load(dmr, naics, year), path, reports.industry_order())
        stored = spark.read.option("header", True).csv(path)
        summary = stored.agg(
            F.lit(year).alias("year"), F.lit(",".join(stored.columns)).alias("header"), F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col("total_annual_load_kg").cast("double")).alias("total"),
        )
        found = summary if found is None else found.unionByName(summary)
    return found


REPORT_HEADER = "NAICS_DESC,total_annual_load_kg,avg_daily_load_per_report_kg,num_paired_measurements"
REPORTS_BY_YEAR = f"""
SELECT '1900' AS year, '{REPORT_HEADER}' AS header, 0 AS n_rows, NULL::DOUBLE AS total
UNION ALL
SELECT '2024', '{REPORT_HEADER}', count(*), sum(total_annual_load_kg) FROM ({loads.BY_SECTOR})
"""


def stored_list(spark, sf_dir):
    """The name list as its file gives it back."""
    path = scratch_path(spark, "names")
    sinks.write_list(nesting.names(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "name")


def line_breaks(spark, sf_dir):
    """CSV with line breaks and quotes in fields of a third of the records -> ingest, and extract -> counts by state."""
    folder, output, sites = scratch_path(spark, "csv"), scratch_path(spark, "dmr"), scratch_path(spark, "sites")
    event = F.col("source_pos.row")
    rows = t.dmr_from_events(spark, sf_dir).withColumns({
        "ACTIVITY_ID": F.when(event % 11 == 0, F.lit("first\n\nline")).otherwise(F.lit('5" pipe')),
        "LIMIT_SET_ID": F.when(event % 7 == 0, F.lit('in "two",\nlines')),
        "RNC_RESOLUTION_DATE": F.when(event % 13 == 0, F.lit("last\n")),
    })
    _as_csv(rows, S.DMR_COLUMNS, scans.source_path(folder, "2024"))
    facilities = t.raw_facilities(spark, sf_dir, "events").withColumn("FACILITY_NAME", F.lit("of\ntwo lines"))
    _as_csv(facilities.orderBy("source_pos"), S.FACILITY_COLUMNS, f"{folder}/facilities.csv")
    ingest.ingest_dmr(spark, folder, output, 2024, 2024, max_malformed=0)
    extracts.store_sites(
        scans.scan_dmr(spark, folder, ["2024"], checked=True),
        scans.scan_facilities(spark, f"{folder}/facilities.csv", checked=True), sites, max_malformed=0,
    )
    stored = scans.read_dmr(spark, output).groupBy("state").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("LIMIT_SET_ID") == 'in "two",\nlines').alias("in_two"),
        F.count_if(F.col("ACTIVITY_ID").endswith("line")).alias("broken_first"), F.count("RNC_RESOLUTION_DATE").alias("broken_last"),
    )
    nested = scans.read_sites(spark, sites).groupBy("state").agg(F.sum(F.size("measurements")).alias("n")).withColumns(
        {name: F.lit(0).cast("bigint") for name in ("in_two", "broken_first", "broken_last")}
    )
    return stored.withColumn("job", F.lit("ingest")).unionByName(nested.withColumn("job", F.lit("extract")))


LINE_BREAKS = f"""
WITH {nesting.ROWS}
SELECT 'ingest' AS job, left(user_id::VARCHAR, 2) AS state, count(*) AS n, count(*) FILTER (event_id % 7 = 0) AS in_two,
       count(*) FILTER (event_id % 11 = 0) AS broken_first, count(*) FILTER (event_id % 13 = 0) AS broken_last
FROM events GROUP BY left(user_id::VARCHAR, 2)
UNION ALL
SELECT 'extract', state, count(*), 0, 0, 0 FROM event_rows GROUP BY state
"""


def refused(spark, sf_dir):
    """A source whose lines are malformed is refused; what an earlier run stored of that year is still there."""
    good, bad, output = scratch_path(spark, "good"), scratch_path(spark, "bad"), scratch_path(spark, "dmr")
    events = t.dmr_from_events(spark, sf_dir)
    _as_csv(events, S.DMR_COLUMNS, scans.source_path(good, "2024"))
    ingest.ingest_dmr(spark, good, output, 2024, 2024)
    short = events.select(F.concat_ws(",", "EXTERNAL_PERMIT_NMBR", "DMR_UNIT_DESC").alias("value"))
    short.write.text(scans.source_path(bad, "2024"))
    try:
        ingest.ingest_dmr(spark, bad, output, 2024, 2024)
        was_refused = False
    except ValueError:
        was_refused = True
    stored = scans.read_dmr(spark, output).groupBy("year", "state").agg(F.count(F.lit(1)).alias("n"))
    return stored.withColumn("was_refused", F.lit(was_refused))


REFUSED = """
SELECT '2024' AS year, left(user_id::VARCHAR, 2) AS state, count(*) AS n, TRUE AS was_refused
FROM events GROUP BY left(user_id::VARCHAR, 2)
"""


def menus(spark, sf_dir):
    """Stored pollutant folders, one of them named for no year -> names from the listing -> stored menus -> read back."""
    folders, out = scratch_path(spark, "pollutants"), scratch_path(spark, "menus")
    pollutants = extracts.pollutant_measurements(nesting.event_sites(spark, sf_dir))
    undated = pollutants.withColumns({"year": F.lit("undated"), "safe_name": F.concat("safe_name", F.lit("_old"))})
    sinks.write_pollutant_json(pollutants.unionByName(undated), folders)
    listed = scans.pollutant_folders(spark, folders)
    sinks.write_list(extracts.pollutant_names(listed), f"{out}/names")
    tables = {
        "pollutants": extracts.pollutant_catalogue(listed), "years": extracts.catalogue_years(spark),
        "states": extracts.catalogue_states(spark),
    }
    for name, table in tables.items():
        sinks.write_table_json(table, f"{out}/{name}")
    back = {name: spark.read.schema(table.schema).json(f"{out}/{name}") for name, table in tables.items()}
    counted = [
        back[name].agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), F.min(c), F.max(c)).alias("item")).withColumn("menu", F.lit(name))
        for name, c in (("years", "year"), ("states", "state"))
    ]
    shown = back["pollutants"].select(F.concat_ws("|", "filename", "displayName").alias("item"), F.lit("pollutants").alias("menu"))
    names = spark.read.text(f"{out}/names").select(F.col("value").alias("item"), F.lit("names").alias("menu"))
    return shown.unionByName(names).unionByName(counted[0]).unionByName(counted[1])


MENUS = f"""
WITH {nesting.ROWS},
names AS (SELECT DISTINCT {nesting.SAFE.format("pollutant")} AS name FROM event_rows),
files AS (SELECT name FROM names UNION ALL SELECT name || '_old' FROM names)
SELECT 'names' AS menu, name AS item FROM names
UNION ALL SELECT 'pollutants', name || '.json|' || replace(name, '_', ' ') FROM files
UNION ALL SELECT 'years', '{S.CATALOGUE_LAST_YEAR - S.CATALOGUE_FIRST_YEAR + 1} {S.CATALOGUE_FIRST_YEAR} {S.CATALOGUE_LAST_YEAR}'
UNION ALL SELECT 'states', '{len(S.STATE_CODES)} {min(S.STATE_CODES)} {max(S.STATE_CODES)}'
"""


CASES = [
    Case("dmr_ingest_round_trip", dmr_round_trip, DMR_ROUND_TRIP),
    Case("backfill_state", facilities_round_trip, FACILITIES_ROUND_TRIP),
    Case("backfill_counts", backfill_counts, BACKFILL_COUNTS),
    Case("permits_ingest_round_trip", permits_round_trip, PERMITS_ROUND_TRIP),
    Case("naics_ingest_round_trip", naics_round_trip, NAICS_ROUND_TRIP),
    Case("ad_sites_scan", ad_sites_scan, AD_SITES_SCAN),
    Case("nested_json_round_trip", json_round_trip, JSON_ROUND_TRIP),
    Case("sector_report_csv", report_round_trip, loads.BY_SECTOR),
    Case("predicate_inspect", inspected, INSPECTED),
    Case("try_parse", parsed, PARSED),
    Case("daily_model_rows", daily_model_rows, DAILY_MODEL_ROWS),
    Case("gbt_forecast", gbt_daily, GBT_DAILY),
    Case("gbt_facility_forecasts", gbt_facilities, GBT_FACILITIES),
    Case("empty_report", empty_report, loads.BY_SECTOR.replace("GROUP BY", "AND 1 = 0 GROUP BY")),
    Case("reports_by_year_stored", reports_by_year, REPORTS_BY_YEAR),
    Case("name_list_stored", stored_list, nesting.NAMES),
    Case("line_break_round_trip", line_breaks, LINE_BREAKS),
    Case("refused_ingest_keeps_rows", refused, REFUSED),
    Case("menus_stored", menus, MENUS),
]

"""Command line of the jobs, for spark-submit or ``python -m rillgauge``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from rillgauge import schemas as S
from rillgauge.operators import inspect as inspector
from rillgauge.plans import extracts, forecast, ingest, reports
from rillgauge.session import get_session, release
from rillgauge.sources import scans, sinks

log = logging.getLogger(__name__)

TRAINING = {"rounds": int, "rate": float, "depth": int, "bins": int, "patience": int}


def _log_counts(counts):
    for name, n in counts.items():
        log.info("%s: %d", name, n)


def run_ingest_dmr(spark, a):
    _log_counts(ingest.ingest_dmr(spark, a.input, a.output, a.start_year, a.end_year, a.max_malformed))


def run_ingest_facilities(spark, a):
    _log_counts(ingest.ingest_facilities(spark, a.input, a.output, a.max_malformed))


def run_ingest_permits(spark, a):
    _log_counts(ingest.ingest_permits(spark, a.input, a.output, a.max_malformed))


def run_ingest_naics(spark, a):
    _log_counts(ingest.ingest_naics(spark, a.input, a.output, a.max_malformed))


def _report(report, path, order, limit=None, hidden=(), shown=reports.PREVIEW_ROWS):
    """Store a report and print its first ``shown`` rows, or all of them when it is None."""
    sinks.write_report(report, path, order, limit, hidden)
    written = report.sparkSession.read.option("header", True).csv(path)
    if written.isEmpty():
        log.warning("no paired readings found")
    else:
        written.show(written.count() if shown is None else shown, truncate=False)


def run_hotspots(spark, a):
    report = reports.hotspots(
        scans.read_dmr(spark, a.dmr), scans.read_facilities(spark, a.facilities), a.year
    )
    _report(
        report, a.output, reports.hotspots_order(), reports.HOTSPOT_ROWS, ("unrounded_load", "permit")
    )


def run_industry(spark, a):
    report = reports.industry_load(
        scans.read_dmr(spark, a.dmr), scans.read_naics(spark, a.naics), a.year,
        primary_only=a.primary_only,
    )
    _report(report, a.output, reports.industry_order())


def run_timeseries(spark, a):
    dmr = scans.read_dmr(spark, a.dmr)
    log.info("rows of the states: %d", reports.paired_rows(dmr, a.states).count())
    _report(reports.regional_timeseries(dmr, a.states), a.output, reports.regional_order(), shown=None)


def _write_forecast(result, output, run):
    if result.predictions is None:
        log.warning("not enough data to model")
    for name in ("predictions", "metrics", "importance", "nodes", "skipped"):
        table = getattr(result, name)
        if table is not None:
            sinks.write_run(table, f"{output}/{name}", run)


def _training(a, default):
    given = {k: getattr(a, k) for k in TRAINING if getattr(a, k) is not None}
    return replace(default, **given)


def run_daily_forecast(spark, a):
    result = forecast.daily_forecast(scans.read_dmr(spark, a.dmr), a.parameter, _training(a, forecast.DAILY))
    _write_forecast(result, a.output, a.run)


def run_facility_forecasts(spark, a):
    result = forecast.facility_forecasts(
        scans.read_dmr(spark, a.dmr), scans.read_permits(spark, a.permits), a.state, a.parameter,
        n=a.n, settings=_training(a, forecast.MONTHLY), leak_free=a.leak_free,
    )
    _write_forecast(result, a.output, a.run)


def run_site_extract(spark, a):
    labels = scans.present_labels(spark, a.input, a.labels)
    if labels:
        _log_counts(extracts.store_sites(
            scans.scan_dmr(spark, a.input, labels, checked=True),
            scans.scan_facilities(spark, f"{a.input}/ICIS_FACILITIES.csv", checked=True),
            a.output, by_month=a.by_month, max_malformed=a.max_malformed,
        ))
        stored = scans.read_sites(spark, a.output)
        log.info("facilities located: %d", stored.select("npdes").distinct().count())
        if a.json:
            sinks.write_site_json(stored, a.json)


def run_pollutant_extract(spark, a):
    pollutants = extracts.pollutant_measurements(scans.read_sites(spark, a.input))
    sinks.write_pollutant_json(pollutants, a.output)


def run_catalogue(spark, a):
    pollutants = scans.pollutant_folders(spark, a.input)
    for row in pollutants.groupBy("year").count().orderBy("year").collect():
        log.info("%s: %d pollutants", row["year"], row["count"])
    sinks.write_table_json(extracts.pollutant_catalogue(pollutants), f"{a.output}/pollutants")
    sinks.write_table_json(extracts.catalogue_years(spark), f"{a.output}/years")
    sinks.write_table_json(extracts.catalogue_states(spark), f"{a.output}/states")


def run_names(spark, a):
    sinks.write_list(extracts.pollutant_names(scans.pollutant_folders(spark, a.input)), a.output)


def run_view(spark, a):
    view = extracts.site_view(
        scans.read_sites(spark, a.input), scans.scan_ad_sites(spark, a.ad_sites), a.year,
        state=a.state, pollutant=a.pollutant, ad_mode=a.ad, label_only=a.label_only,
    )
    sinks.write_table_json(view, a.output)


def run_inspect(spark, a):
    df = spark.read.parquet(a.path)
    df.printSchema()
    if not a.schema:
        matching = inspector.inspect(df, a.columns, a.filter or (), rows=None)
        log.info("matching rows: %d", matching.count())
        matching.show(a.rows, truncate=40)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rillgauge")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *positional):
        p = jobs.add_parser(name)
        for argument in positional:
            p.add_argument(argument)
        p.set_defaults(run_job=run)
        return p

    def training(p):
        for name, kind in TRAINING.items():
            p.add_argument(f"--{name}", type=kind)

    def reading(name, run, *positional):
        p = job(name, run, *positional)
        p.add_argument("--max-malformed", type=float, default=ingest.MAX_MALFORMED, help="share of malformed lines to bear")
        return p

    p = reading("ingest-dmr", run_ingest_dmr, "input", "output")
    p.add_argument("--start-year", type=int, required=True)
    p.add_argument("--end-year", type=int, required=True)
    reading("ingest-facilities", run_ingest_facilities, "input", "output")
    reading("ingest-permits", run_ingest_permits, "input", "output")
    reading("ingest-naics", run_ingest_naics, "input", "output")

    p = job("hotspots", run_hotspots, "dmr", "facilities", "output")
    p.add_argument("--year", required=True)
    p = job("industry", run_industry, "dmr", "naics", "output")
    p.add_argument("--year", required=True)
    p.add_argument("--primary-only", action="store_true")
    p = job("timeseries", run_timeseries, "dmr", "output")
    p.add_argument("--states", nargs="+", required=True)

    p = job("daily-forecast", run_daily_forecast, "dmr", "output")
    p.add_argument("--parameter", default=S.N_PARAM)
    p.add_argument("--run", required=True)
    training(p)
    p = job("facility-forecasts", run_facility_forecasts, "dmr", "permits", "output")
    p.add_argument("--state", default="OH")
    p.add_argument("--parameter", default=S.N_PARAM)
    p.add_argument("-n", type=int, default=5)
    p.add_argument("--leak-free", action="store_true")
    p.add_argument("--run", required=True)
    training(p)

    p = reading("site-extract", run_site_extract, "input", "output")
    p.add_argument("--by-month", action="store_true", help="cut records by month, not by year")
    p.add_argument("--labels", nargs="+", help="labels to take; all that are there by default")
    p.add_argument("--json", help="folder of a JSON export")
    job("pollutant-extract", run_pollutant_extract, "input", "output")
    job("catalogue", run_catalogue, "input", "output")
    job("pollutant-names", run_names, "input", "output")
    p = job("site-view", run_view, "input", "ad_sites", "output")
    p.add_argument("--year", required=True)
    p.add_argument("--state")
    p.add_argument("--pollutant")
    p.add_argument("--ad", choices=["all", "only", "exclude"], default="all")
    p.add_argument("--label-only", action="store_true")

    p = job("inspect", run_inspect, "path")
    p.add_argument("-c", "--columns", nargs="+")
    p.add_argument("-f", "--filter", nargs=3, action="append", metavar=("COLUMN", "OP", "VALUE"))
    p.add_argument("-n", "--rows", type=int, default=10)
    p.add_argument("-s", "--schema", action="store_true")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    arguments = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = spark or get_session(f"rillgauge {arguments.job}")
    try:
        arguments.run_job(spark, arguments)
    finally:
        release(spark)

"""Forecasts: boosted trees over daily or monthly features, one model per series."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgauge import schemas as S
from rillgauge.functions import clean
from rillgauge.operators import boosting
from rillgauge.operators import timeseries as ts
from rillgauge.operators.boosting import Boosting
from rillgauge.plans import reports
from rillgauge.session import materialised, scratch_path

DAILY = Boosting(rate=0.05, patience=10)
MONTHLY = Boosting(rate=0.3, patience=50)
FITS_AT_ONCE = 4


@dataclass(frozen=True)
class Forecast:
    """Result tables of a run, each with a ``series`` column; None where nothing was fitted.

    ``metrics`` has the errors on the test rows, the ``rounds`` of the best model and those ``grown``; ``nodes`` has the
    trees, see :func:`boosting.stored_nodes`, from which ``importance`` is counted.
    """

    predictions: DataFrame | None = None
    metrics: DataFrame | None = None
    importance: DataFrame | None = None
    nodes: DataFrame | None = None
    skipped: DataFrame | None = None


def train_series(
    featured: DataFrame, series: Sequence[str], names: Sequence[str], settings: Boosting, order: str = "weight"
) -> Forecast:
    """One model per listed series over a stored feature table with ``series`` and ``is_test``.

    The list is bounded by the caller's top n, and a series by the calendar, so these are a
    few fits over small tables; independent ones run side by side. Features are listed by ``order``, the number of
    their splits (``weight``) or the share of their gain (``importance``).
    """
    spark = featured.sparkSession
    vectors = VectorAssembler(inputCols=list(names), outputCol="vector").transform(featured)

    def one(key: str) -> tuple[DataFrame, DataFrame, DataFrame, tuple[str, int, int]]:
        rows = materialised(vectors.filter(F.col("series") == key).coalesce(1), "series")  # a row a day at most
        fitted = boosting.fit(rows, settings)
        path = scratch_path(spark, "model")
        fitted.model.write().save(path)
        nodes = boosting.stored_nodes(spark, path)
        scored = fitted.model.transform(rows.filter("is_test")).drop("vector", "is_test")
        importance = boosting.split_importance(nodes, list(names)).withColumn("series", F.lit(key))
        return scored, importance, nodes.withColumn("series", F.lit(key)), (key, fitted.rounds, fitted.grown)

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        fitted = list(pool.map(one, series))
    if not fitted:
        return Forecast()
    scored, importance, nodes = (reduce(DataFrame.unionByName, tables) for tables in list(zip(*fitted))[:3])
    scored = scored.withColumnRenamed("target", "y_test")
    rounds = spark.createDataFrame([f[3] for f in fitted], "series string, rounds int, grown int")
    metrics = ts.error_metrics(scored, ["series"], "y_test", "prediction").join(rounds, "series")
    ordered = importance.select("series", "feature", "importance", "weight", "gain").orderBy(
        "series", F.col(order).desc(), "feature"
    )
    return Forecast(scored, metrics, ordered, nodes)


def daily_series(dmr: DataFrame, parameter: str, unit: str = S.CONCENTRATION_UNIT) -> DataFrame:
    """Filled daily mean of one parameter over all permits, as one series."""
    rows = dmr.filter((F.col("DMR_UNIT_DESC") == unit) & (F.col("PARAMETER_DESC") == parameter))
    readings = rows.select(
        F.col("PARAMETER_DESC").alias("series"),
        clean.to_period_date("MONITORING_PERIOD_END_DATE").alias("day"),
        clean.to_finite_text_number("DMR_VALUE_NMBR").alias("reading"),
    ).dropna()
    return ts.fill_days(ts.bucket_mean(readings, ["series"], "day", "reading"), ["series"])


def daily_model_table(dmr: DataFrame, parameter: str) -> DataFrame:
    """Complete daily feature rows with the chronological split."""
    featured = ts.daily_features(daily_series(dmr, parameter), ["series"])
    return ts.split_first(featured.dropna(subset=ts.DAILY_FEATURES), ["series"])


def daily_forecast(dmr: DataFrame, parameter: str, settings: Boosting = DAILY) -> Forecast:
    """Forecast the daily mean of a parameter; empty when there is nothing to split."""
    table = materialised(daily_model_table(dmr, parameter), "daily")
    if table.filter("is_test").isEmpty() or table.filter(~F.col("is_test")).isEmpty():
        return Forecast()
    return train_series(table, [parameter], ts.DAILY_FEATURES, settings)


def monthly_series(dmr: DataFrame, parameter: str, permits: Sequence[str]) -> DataFrame:
    """Monthly mean of a parameter for the listed permits; absent months stay absent.

    The list is a filter on raw columns, so files sorted by permit skip row groups.
    """
    rows = dmr.filter(
        (F.col("PARAMETER_DESC") == parameter) & F.col("EXTERNAL_PERMIT_NMBR").isin(list(permits))
    )
    readings = rows.select(
        F.col("EXTERNAL_PERMIT_NMBR").alias("series"),
        clean.to_period_date("MONITORING_PERIOD_END_DATE").alias("day"),
        clean.to_finite_text_number("DMR_VALUE_STANDARD_UNITS").alias("reading"),
    ).dropna()
    return ts.bucket_mean(readings, ["series"], "day", "reading", unit="month")


def facility_forecasts(
    dmr: DataFrame, permits: DataFrame, state: str | None, parameter: str,
    f_param: str = S.F_PARAM, n: int = 5, settings: Boosting = MONTHLY, leak_free: bool = False,
    min_points: int = 24, min_featured: int = 12,
) -> Forecast:
    """One monthly forecast for each of the n permits with the largest load.

    Permits with too few months are left out and listed in ``skipped`` with the reason.
    """
    spark = dmr.sparkSession
    rows = dmr if state is None else dmr.filter(F.col("state") == state)
    ranking = reports.top_facilities_by_load(dmr, reports.reporting_permits(permits, rows), state, parameter, f_param, n)
    top = [r.EXTERNAL_PERMIT_NMBR for r in ranking.collect()]
    if not top:
        return Forecast()
    featured = materialised(
        ts.monthly_features(monthly_series(rows, parameter, top), ["series"], leak_free), "monthly"
    )
    counted = ts.series_gates(featured, ["series"], ts.MONTHLY_FEATURES, min_points, min_featured)
    # Every ranked permit is either fitted or skipped, one without any month too.
    ranked = spark.createDataFrame([(k,) for k in top], "series string")
    gates = ranked.join(counted, "series", "left").select(
        "series", F.coalesce("points", F.lit(0)).alias("points"),
        F.coalesce("featured_points", F.lit(0)).alias("featured_points"),
        F.when(F.col("points").isNull(), F.lit("too few points")).otherwise(F.col("skip_reason")).alias("skip_reason"),
    )
    ready = ts.split_last(featured.dropna(subset=ts.MONTHLY_FEATURES), ["series"])
    kept = [r.series for r in gates.filter("skip_reason IS NULL").orderBy("series").limit(n).collect()]
    result = train_series(ready, kept, ts.MONTHLY_FEATURES, settings, order="importance")
    return replace(result, skipped=gates.filter("skip_reason IS NOT NULL"))



"""Time-series operators: resampling, features, calendar codes, splits, gates, errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from analogues import tables as t
from analogues.case import Case
from rillgauge.functions import clean
from rillgauge.operators import timeseries as ts


def _rounded(df, names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


def _events_daily(spark, sf_dir):
    return ts.bucket_mean(t.table(spark, sf_dir, "events"), ["user_id"], "ts", "value")


def _orders_daily(spark, sf_dir):
    """Daily means of square-rooted prices: their means never end in an exact half."""
    orders = t.table(spark, sf_dir, "orders").withColumn("root", F.sqrt("o_totalprice"))
    return ts.bucket_mean(orders, ["o_orderpriority"], "o_orderdate", "root")


def _lineitem_monthly(spark, sf_dir, key="l_suppkey"):
    rows = t.table(spark, sf_dir, "lineitem").withColumn("root", F.sqrt("l_quantity"))
    return ts.bucket_mean(rows, [key], "l_shipdate", "root", unit="month")


ORDERS_DAILY = """
daily AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS bucket, avg(sqrt(o_totalprice)) AS value
  FROM orders GROUP BY ALL)
"""
ORDERS_FILLED = f"""
{ORDERS_DAILY},
spine AS (
  SELECT o_orderpriority,
         unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 DAY))::DATE AS bucket
  FROM daily GROUP BY o_orderpriority),
filled AS (
  SELECT o_orderpriority, bucket,
         last_value(value IGNORE NULLS) OVER (
           PARTITION BY o_orderpriority ORDER BY bucket
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM spine LEFT JOIN daily USING (o_orderpriority, bucket))
"""


def resample(spark, sf_dir):
    filled = ts.fill_days(_events_daily(spark, sf_dir), ["user_id"])
    return _rounded(filled, ["observed", "value"])


RESAMPLE = """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS bucket, avg(value) AS value FROM events GROUP BY ALL),
spine AS (
  SELECT user_id, unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 DAY))::DATE AS bucket
  FROM daily GROUP BY user_id)
SELECT user_id, bucket, round(value, 6) AS observed,
       round(last_value(value IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY bucket
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
FROM spine LEFT JOIN daily USING (user_id, bucket)
"""

DAILY_NUMBERS = ["target", *[f"lag_{i}" for i in range(1, 8)], "rolling_mean_7", "rolling_std_7",
                 "rolling_mean_3", "rolling_mean_30", "lag_1_diff"]


def daily_lag_rolling(spark, sf_dir):
    filled = ts.fill_days(_orders_daily(spark, sf_dir), ["o_orderpriority"])
    return _rounded(ts.daily_features(filled, ["o_orderpriority"]), DAILY_NUMBERS, 4)


def _guarded(fn, width, shift, alias, places):
    frame = (f"(PARTITION BY {{key}} ORDER BY bucket ROWS BETWEEN {width - 1 + shift} PRECEDING "
             f"AND {shift} PRECEDING)")
    return (f"round(CASE WHEN count(value) OVER {frame} = {width} "
            f"THEN {fn}(value) OVER {frame} END, {places}) AS {alias}")


def _lag(i, places):
    return f"round(lag(value, {i}) OVER (PARTITION BY {{key}} ORDER BY bucket), {places}) AS lag_{i}"


DAILY_COLUMNS = ",\n       ".join(
    [_lag(i, 4) for i in range(1, 8)]
    + [
        _guarded("avg", 7, 1, "rolling_mean_7", 4),
        _guarded("stddev_samp", 7, 1, "rolling_std_7", 4),
        _guarded("avg", 3, 1, "rolling_mean_3", 4),
        _guarded("avg", 30, 1, "rolling_mean_30", 4),
        "round(lag(value, 1) OVER (PARTITION BY {key} ORDER BY bucket)"
        " - lag(value, 2) OVER (PARTITION BY {key} ORDER BY bucket), 4) AS lag_1_diff",
    ]
).format(key="o_orderpriority")

DAILY_LAG_ROLLING = f"""
WITH {ORDERS_FILLED}
SELECT o_orderpriority, bucket, round(value, 4) AS target,
       {DAILY_COLUMNS},
       (isodow(bucket) - 1)::INTEGER AS day_of_week,
       weekofyear(bucket)::INTEGER AS week_of_year,
       month(bucket)::INTEGER AS month,
       (dense_rank() OVER (
          PARTITION BY o_orderpriority
          ORDER BY month(bucket)::VARCHAR || '_' || (isodow(bucket) - 1)::VARCHAR) - 1)::INTEGER
         AS month_day_interaction
FROM filled
"""


def monthly(spark, sf_dir):
    featured = ts.monthly_features(_lineitem_monthly(spark, sf_dir), ["l_suppkey"])
    return _rounded(featured, ["target", "lag_1", "lag_3", "lag_12", "rolling_mean_3",
                               "rolling_std_3", "rolling_mean_12"], 5)


def monthly_leak_free(spark, sf_dir):
    featured = ts.monthly_features(_lineitem_monthly(spark, sf_dir), ["l_suppkey"], leak_free=True)
    return _rounded(featured, ["target", "lag_1", "lag_3", "lag_12", "rolling_mean_3",
                               "rolling_std_3", "rolling_mean_12"], 5)


def _monthly_sql(shift):
    columns = ",\n       ".join(
        [_lag(i, 5) for i in (1, 3, 12)]
        + [
            _guarded("avg", 3, shift, "rolling_mean_3", 5),
            _guarded("stddev_samp", 3, shift, "rolling_std_3", 5),
            _guarded("avg", 12, shift, "rolling_mean_12", 5),
        ]
    ).format(key="l_suppkey").replace("AND 0 PRECEDING", "AND CURRENT ROW")
    return f"""
WITH {_months_sql("l_suppkey")}
SELECT l_suppkey, bucket, round(value, 5) AS target, month(bucket)::INTEGER AS month,
       year(bucket)::INTEGER AS year, quarter(bucket)::INTEGER AS quarter,
       {columns}
FROM months
"""


def _months_sql(key):
    return f"""months AS (
  SELECT {key}, CAST(date_trunc('month', l_shipdate) AS DATE) AS bucket, avg(sqrt(l_quantity)) AS value
  FROM lineitem GROUP BY ALL)"""


def calendar_code(spark, sf_dir):
    days = _orders_daily(spark, sf_dir).select("o_orderpriority", "bucket")
    return days.select(
        "o_orderpriority",
        "bucket",
        F.weekday("bucket").alias("day_of_week"),
        F.weekofyear("bucket").alias("week_of_year"),
        F.month("bucket").alias("month"),
        F.quarter("bucket").alias("quarter"),
        F.year("bucket").alias("year"),
        ts.interaction_code(["o_orderpriority"]).alias("code"),
    )


CALENDAR_CODE = f"""
WITH {ORDERS_DAILY}
SELECT o_orderpriority, bucket, (isodow(bucket) - 1)::INTEGER AS day_of_week,
       weekofyear(bucket)::INTEGER AS week_of_year, month(bucket)::INTEGER AS month,
       quarter(bucket)::INTEGER AS quarter, year(bucket)::INTEGER AS year,
       (dense_rank() OVER (
          PARTITION BY o_orderpriority
          ORDER BY month(bucket)::VARCHAR || '_' || (isodow(bucket) - 1)::VARCHAR) - 1)::INTEGER AS code
FROM daily
"""


def split_first(spark, sf_dir):
    days = _orders_daily(spark, sf_dir).select("o_orderpriority", "bucket")
    return ts.split_first(days, ["o_orderpriority"])


SPLIT_FIRST = f"""
WITH {ORDERS_DAILY}
SELECT o_orderpriority, bucket,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY bucket)
         > floor(0.8::DOUBLE * count(*) OVER (PARTITION BY o_orderpriority)) AS is_test
FROM daily
"""


def split_last(spark, sf_dir):
    months = _lineitem_monthly(spark, sf_dir).select("l_suppkey", "bucket")
    return ts.split_last(months, ["l_suppkey"])


SPLIT_LAST = f"""
WITH {_months_sql("l_suppkey")}
SELECT l_suppkey, bucket,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY bucket)
         > count(*) OVER (PARTITION BY l_suppkey)
           - greatest(1, floor(0.2::DOUBLE * count(*) OVER (PARTITION BY l_suppkey))) AS is_test
FROM months
"""


def gates(spark, sf_dir):
    featured = ts.monthly_features(_lineitem_monthly(spark, sf_dir, "l_partkey"), ["l_partkey"])
    return ts.series_gates(featured, ["l_partkey"], ts.MONTHLY_FEATURES, 24, 16)


GATES = f"""
WITH {_months_sql("l_partkey")},
featured AS (
  SELECT l_partkey, lag(value, 12) OVER (PARTITION BY l_partkey ORDER BY bucket) AS lag_12 FROM months),
counts AS (
  SELECT l_partkey, count(*) AS points, count(lag_12) AS featured_points
  FROM featured GROUP BY l_partkey)
SELECT l_partkey, points, featured_points,
       CASE WHEN points < 24 THEN 'too few points'
            WHEN featured_points < 16 THEN 'too few featured points' END AS skip_reason
FROM counts
"""


def errors(spark, sf_dir):
    naive = F.lag("value", 1).over(ts.by_series(["o_orderpriority"]))
    scored = _orders_daily(spark, sf_dir).withColumn("prediction", naive)
    measured = ts.error_metrics(scored, ["o_orderpriority"], "value", "prediction")
    return _rounded(measured, ["mae", "rmse"], 4)


ERRORS = f"""
WITH {ORDERS_DAILY},
scored AS (
  SELECT o_orderpriority, value,
         lag(value, 1) OVER (PARTITION BY o_orderpriority ORDER BY bucket) AS prediction
  FROM daily)
SELECT o_orderpriority, round(avg(abs(value - prediction)), 4) AS mae,
       round(sqrt(avg((value - prediction) * (value - prediction))), 4) AS rmse,
       count(value - prediction) AS n
FROM scored GROUP BY o_orderpriority
"""


def calendar_years(spark, sf_dir):
    """File label and calendar year of every reading."""
    shipped = t.table(spark, sf_dir, "lineitem").select(F.add_months("l_shipdate", 144).alias("d"))
    text = F.date_format("d", "M/d/yyyy")
    return (
        shipped.select(
            F.year(clean.to_period_date(text)).alias("cal_year"),
            clean.label_of_year(clean.year_suffix(text)).alias("label"),
        )
        .groupBy("cal_year", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


CALENDAR_YEARS = """
WITH shipped AS (SELECT year(l_shipdate + INTERVAL 144 MONTH) AS y FROM lineitem)
SELECT y::INTEGER AS cal_year, CASE WHEN y < 2009 THEN 'PREFY2009' ELSE y::VARCHAR END AS label,
       count(*) AS n
FROM shipped GROUP BY ALL
"""

CASES = [
    Case("daily_resample_ffill", resample, RESAMPLE),
    Case("daily_lag_rolling", daily_lag_rolling, DAILY_LAG_ROLLING),
    Case("monthly_features", monthly, _monthly_sql(0)),
    Case("monthly_features_leak_free", monthly_leak_free, _monthly_sql(1)),
    Case("calendar_code", calendar_code, CALENDAR_CODE),
    Case("chrono_split_first", split_first, SPLIT_FIRST),
    Case("chrono_split_last", split_last, SPLIT_LAST),
    Case("series_gates", gates, GATES),
    Case("error_metrics", errors, ERRORS),
    Case("year_labels", calendar_years, CALENDAR_YEARS),
]

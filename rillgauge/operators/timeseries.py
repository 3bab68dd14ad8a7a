"""Regular series, lags, rolling statistics, calendar parts and chronological splits.

A series is rows (keys, bucket DATE, value). Raw rows are first reduced by a
distributed mean per bucket, so a series holds at most one row per day or month
and the windows below run over calendar-sized groups whatever the raw volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_series(keys: Sequence[str], bucket: str = "bucket") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(bucket)


def bucket_mean(
    df: DataFrame, keys: Sequence[str], date: str | Column, value: str | Column, unit: str = "day",
) -> DataFrame:
    """Mean value by day, or by month (dated at its first day)."""
    day = F.to_date(F.col(date) if isinstance(date, str) else date)
    bucket = F.trunc(day, "month") if unit == "month" else day
    return df.groupBy(*keys, bucket.alias("bucket")).agg(F.avg(value).alias("value"))


def fill_days(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per day from first to last: ``observed`` is NULL on absent days,
    ``value`` carries the last observation forward.

    Each observed day is expanded to the days before the next one, so the spine
    and the fill need neither a join nor a second pass.
    """
    following = F.lead("bucket").over(by_series(keys))
    last_day = F.coalesce(F.date_sub(following, 1), F.col("bucket"))
    return (
        buckets.withColumn("last_day", last_day)
        .withColumn("day", F.explode(F.sequence("bucket", "last_day")))
        .select(
            *keys,
            F.col("day").alias("bucket"),
            F.when(F.col("day") == F.col("bucket"), F.col("value")).alias("observed"),
            "value",
        )
    )


def lag_columns(w: WindowSpec, steps: Sequence[int], value: str = "value") -> dict[str, Column]:
    return {f"lag_{i}": F.lag(value, i).over(w) for i in steps}


def rolling(stat, w: WindowSpec, width: int, shift: int, value: str = "value") -> Column:
    """Statistic of the last ``width`` rows, ``shift`` rows back, NULL until full."""
    frame = w.rowsBetween(-(width - 1) - shift, -shift)
    return F.when(F.count(value).over(frame) == width, stat(value).over(frame))


def daily_features(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target, lags, shifted rolling statistics and calendar parts of a daily series."""
    w = by_series(keys)
    month, weekday = F.month("bucket"), F.weekday("bucket")
    columns = {
        "target": F.col("value"),
        **lag_columns(w, range(1, 8)),
        "rolling_mean_7": rolling(F.avg, w, 7, 1),
        "rolling_std_7": rolling(F.stddev_samp, w, 7, 1),
        "rolling_mean_3": rolling(F.avg, w, 3, 1),
        "rolling_mean_30": rolling(F.avg, w, 30, 1),
        "lag_1_diff": F.lag("value", 1).over(w) - F.lag("value", 2).over(w),
        "day_of_week": weekday,
        "week_of_year": F.weekofyear("bucket"),
        "month": month,
    }
    featured = days.select(*keys, "bucket", *[c.alias(n) for n, c in columns.items()])
    return featured.withColumn("month_day_interaction", interaction_code(keys))


def interaction_code(keys: Sequence[str]) -> Column:
    """Code of the text "month_weekday" among the texts of its series, in text order."""
    text = F.concat_ws("_", F.month("bucket"), F.weekday("bucket"))
    return F.dense_rank().over(Window.partitionBy(*keys).orderBy(text)) - 1


# Feature names, in model order.
DAILY_FEATURES = [
    "lag_1", "lag_2", "lag_3", "lag_4", "lag_5", "lag_6", "lag_7", "rolling_mean_7",
    "rolling_std_7", "rolling_mean_3", "rolling_mean_30", "lag_1_diff", "day_of_week",
    "week_of_year", "month", "month_day_interaction",
]
MONTHLY_FEATURES = [
    "month", "year", "quarter", "lag_1", "lag_3", "lag_12", "rolling_mean_3", "rolling_std_3",
    "rolling_mean_12",
]


def monthly_features(months: DataFrame, keys: Sequence[str], leak_free: bool = False) -> DataFrame:
    """Calendar parts, lags and rolling statistics of a monthly series.

    Absent months are not filled: lags count rows. Rolling statistics include the
    current month unless ``leak_free`` shifts them one row back.
    """
    w = by_series(keys)
    shift = 1 if leak_free else 0
    columns = {
        "target": F.col("value"),
        "month": F.month("bucket"),
        "year": F.year("bucket"),
        "quarter": F.quarter("bucket"),
        **lag_columns(w, (1, 3, 12)),
        "rolling_mean_3": rolling(F.avg, w, 3, shift),
        "rolling_std_3": rolling(F.stddev_samp, w, 3, shift),
        "rolling_mean_12": rolling(F.avg, w, 12, shift),
    }
    return months.select(*keys, "bucket", *[c.alias(n) for n, c in columns.items()])


def split_first(df: DataFrame, keys: Sequence[str], train_share: float = 0.8) -> DataFrame:
    """Flag ``is_test``: the first floor(share * n) rows of a series train."""
    position = F.row_number().over(by_series(keys))
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("is_test", position > F.floor(F.lit(train_share) * size))


def split_last(df: DataFrame, keys: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """Flag ``is_test``: the last max(1, floor(share * n)) rows of a series test."""
    position = F.row_number().over(by_series(keys))
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    held_out = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(test_share) * size))
    return df.withColumn("is_test", position > size - held_out)


def series_gates(
    months: DataFrame, keys: Sequence[str], features: Sequence[str],
    min_points: int = 24, min_featured: int = 12,
) -> DataFrame:
    """Point counts of each series and why it is skipped (NULL when it is kept)."""
    complete = F.lit(True)
    for name in features:
        complete = complete & F.col(name).isNotNull()
    return (
        months.groupBy(*keys)
        .agg(F.count("target").alias("points"), F.count_if(complete).alias("featured_points"))
        .withColumn(
            "skip_reason",
            F.when(F.col("points") < min_points, F.lit("too few points")).when(
                F.col("featured_points") < min_featured, F.lit("too few featured points")
            ),
        )
    )


def error_metrics(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Mean absolute error and root mean squared error by series."""
    error = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(error).alias("n"),
    )

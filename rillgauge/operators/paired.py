"""Paired readings: concentration and flow reported for the same permit and period.

Joining the two kinds of rows pairs them many-to-many. For one (permit, period)
the pairs' loads add up to factor * sum(concentration) * sum(flow), the pairs
number rows(concentration) * rows(flow), and pairs with a known load number
known(concentration) * known(flow). So one scan and one grouped aggregate give
what the join would, however many rows a key holds, without building a pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgauge import schemas as S
from rillgauge.functions import clean


@dataclass(frozen=True)
class Pairing:
    """Which columns and parameter names to pair, and the unit factor."""

    entity: str = "EXTERNAL_PERMIT_NMBR"
    period: str = "MONITORING_PERIOD_END_DATE"
    parameter: str = "PARAMETER_DESC"
    value: str = "DMR_VALUE_STANDARD_UNITS"
    n_param: str = S.N_PARAM
    f_param: str = S.F_PARAM
    factor: float = S.LOAD_FACTOR
    extra_keys: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period, *self.extra_keys]


def _readings(dmr: DataFrame, p: Pairing, reported_only: bool) -> DataFrame:
    """Rows of the two parameters with a usable key; raw-column filters push down."""
    rows = dmr.filter(F.col(p.parameter).isin(p.n_param, p.f_param))
    for key in p.keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows.filter(F.col(p.value).isNotNull()) if reported_only else rows


def _side_sums(p: Pairing) -> list[Column]:
    number = clean.to_number(p.value)
    sums = []
    for side, name in (("n", p.n_param), ("f", p.f_param)):
        here = F.col(p.parameter) == name
        sums += [
            F.sum(F.when(here, number)).alias(f"{side}_sum"),
            F.count(F.when(here, number)).alias(f"{side}_known"),
            F.count_if(here).alias(f"{side}_rows"),
        ]
    return sums


def _pair_columns(p: Pairing) -> list[Column]:
    return [
        (F.col("n_sum") * F.col("f_sum") * F.lit(p.factor)).alias("load_sum"),
        (F.col("n_known") * F.col("f_known")).alias("load_known"),
        (F.col("n_rows") * F.col("f_rows")).alias("pairs"),
    ]


def paired_totals(dmr: DataFrame, p: Pairing = Pairing(), reported_only: bool = True) -> DataFrame:
    """Load sum, pairs with a known load and all pairs, by pairing key.

    ``reported_only`` keeps rows with a raw value only; without it a pair with a
    missing value still counts as a pair, and its load is unknown.
    """
    return (
        _readings(dmr, p, reported_only)
        .groupBy(*p.keys)
        .agg(*_side_sums(p))
        .filter((F.col("n_rows") > 0) & (F.col("f_rows") > 0))
        .select(*p.keys, *_pair_columns(p))
    )


def paired_totals_by(
    dmr: DataFrame,
    attributes: Sequence[str],
    p: Pairing = Pairing(),
    reported_only: bool = True,
) -> DataFrame:
    """Paired totals split by attributes of the concentration rows.

    Flow rows pair across attribute values: after the first aggregate the flow
    part is summed over the pairing key, by then a handful of rows per key.
    """
    over_key = Window.partitionBy(*p.keys)
    sides = (
        _readings(dmr, p, reported_only)
        .groupBy(*p.keys, *attributes)
        .agg(*_side_sums(p))
        .select(
            *p.keys,
            *attributes,
            "n_sum",
            "n_known",
            "n_rows",
            *[F.sum(c).over(over_key).alias(c) for c in ("f_sum", "f_known", "f_rows")],
        )
    )
    return sides.filter((F.col("n_rows") > 0) & (F.col("f_rows") > 0)).select(
        *p.keys, *attributes, *_pair_columns(p)
    )


def roll_up(totals: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sum, mean over known loads and pair count of paired totals, by coarser keys."""
    return (
        totals.groupBy(*keys)
        .agg(
            F.sum("load_sum").alias("load_sum"),
            F.sum("load_known").alias("load_known"),
            F.sum("pairs").alias("pairs"),
        )
        .withColumn("load_mean", F.try_divide("load_sum", "load_known"))
    )


def undated_mean_load(
    dmr: DataFrame, permits: DataFrame, p: Pairing = Pairing(),
    average_flow: str = "ACTUAL_AVERAGE_FLOW_NMBR",
) -> DataFrame:
    """Mean load by permit where readings pair on the permit alone, without a date.

    Every concentration row meets every flow row of its permit, so the mean load
    is factor * mean(concentration) * mean(flow). A permit that reports no flow
    row at all uses the mean of its recorded average flows instead.
    """
    number = clean.to_finite_text_number(p.value)
    is_n = F.col(p.parameter) == p.n_param
    is_f = F.col(p.parameter) == p.f_param
    readings = (
        dmr.filter(F.col(p.parameter).isin(p.n_param, p.f_param))
        .filter(F.col(p.entity).isNotNull())
        .groupBy(p.entity)
        .agg(
            F.avg(F.when(is_n, number)).alias("n_mean"),
            F.avg(F.when(is_f, number)).alias("f_mean"),
            (F.count_if(is_f) > 0).alias("flow_reported"),
        )
        .filter(F.col("n_mean").isNotNull())
    )
    recorded = (
        permits.filter(F.col(average_flow).isNotNull())
        .groupBy(p.entity)
        .agg(F.avg(average_flow).alias("recorded_flow"))
    )
    flow = F.when(F.col("flow_reported"), F.col("f_mean")).otherwise(F.col("recorded_flow"))
    return (
        readings.join(recorded, p.entity, "left")
        .withColumn("flow", flow)
        .filter(F.col("flow").isNotNull())
        .select(
            p.entity,
            (F.col("n_mean") * F.col("flow") * F.lit(p.factor)).alias("mean_load"),
            "flow_reported",
        )
    )

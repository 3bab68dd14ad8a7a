"""Load reports against the plain join and against hand-computed answers."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import F_, N, READING, same_rows
from rillgauge import schemas as S
from rillgauge.functions import clean
from rillgauge.operators import paired
from rillgauge.operators.paired import Pairing
from rillgauge.plans import reports

KEYS = ["EXTERNAL_PERMIT_NMBR", "MONITORING_PERIOD_END_DATE"]


def joined_pairs(dmr, reported_only, extra=()):
    """The pairing as a plain join: one row per pair."""
    rows = dmr.filter("DMR_VALUE_STANDARD_UNITS IS NOT NULL") if reported_only else dmr
    number = clean.to_number("DMR_VALUE_STANDARD_UNITS")
    n = rows.filter(F.col("PARAMETER_DESC") == N).select(*KEYS, *extra, "year", "state", number.alias("n"))
    f = rows.filter(F.col("PARAMETER_DESC") == F_).select(*KEYS, *extra, number.alias("f"))
    return n.join(f, [*KEYS, *extra]).withColumn("load", F.col("n") * F.col("f") * S.LOAD_FACTOR)


def random_readings(seed, count=600):
    rnd = random.Random(seed)
    values = [None, "", "<1", "2.5", "4", "0", "1e1", "-3"]
    return [
        (
            rnd.choice(["OH1", "OH1", "OH1", "TX2", "TX3", None]),
            rnd.choice(["01/31/2023", "02/28/2023", "03/31/2023", None]),
            rnd.choice([N, F_, "pH"]),
            rnd.choice(values),
            rnd.choice(["2022", "2023"]),
            rnd.choice(["OH", "TX"]),
        )
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("reported_only", [True, False])
def test_totals_equal_the_join(rows, seed, reported_only):
    dmr = rows(READING, *random_readings(seed))
    expected = joined_pairs(dmr, reported_only).groupBy(*KEYS).agg(
        F.sum("load"), F.count("load"), F.count(F.lit(1))
    )
    assert same_rows(paired.paired_totals(dmr, reported_only=reported_only).collect(), expected.collect())


@pytest.mark.parametrize("seed", [4, 5])
def test_totals_by_attributes_equal_the_join(rows, seed):
    dmr = rows(READING, *random_readings(seed))
    expected = joined_pairs(dmr, True).groupBy(*KEYS, "year", "state").agg(
        F.sum("load"), F.count("load"), F.count(F.lit(1))
    )
    assert same_rows(paired.paired_totals_by(dmr, ["year", "state"]).collect(), expected.collect())


def test_extra_keys_tighten_the_pairing(rows):
    dmr = rows(
        READING.replace("year string", "outfall string, year string"),
        ("OH1", "d", N, "2", "001", "2023", "OH"),
        ("OH1", "d", F_, "3", "002", "2023", "OH"),
        ("OH1", "d", F_, "5", "001", "2023", "OH"),
    )
    assert paired.paired_totals(dmr).first().pairs == 2
    tight = paired.paired_totals(dmr, Pairing(extra_keys=("outfall",))).collect()
    assert [(r.outfall, r.pairs) for r in tight] == [("001", 1)]


FACILITY = "NPDES_ID string, FACILITY_NAME string, CITY string, state string"


def test_hotspots(rows):
    dmr = rows(
        READING,
        *[("OH1", "01/31/2023", N, v, "2023", "OH") for v in ("2", "4")],
        *[("OH1", "01/31/2023", F_, v, "2023", "OH") for v in ("1", "2", "3")],
        ("TX2", "01/31/2023", N, "1.0000001", "2023", "TX"),
        ("TX2", "01/31/2023", F_, "1", "2023", "TX"),
        ("TX3", "01/31/2023", N, "1", "2023", "TX"),
        ("TX3", "01/31/2023", F_, "1", "2023", "TX"),
        ("TX4", "01/31/2023", N, None, "2023", "TX"),
        ("TX4", "01/31/2023", F_, "1", "2023", "TX"),
        ("OH1", "01/31/2022", N, "9", "2022", "OH"),
        ("OH1", "01/31/2022", F_, "9", "2022", "OH"),
    )
    facilities = rows(
        FACILITY, ("OH1", "one", "c", "OH"), ("TX2", "two", "c", "TX"), ("TX3", "three", "c", "TX"),
        ("TX4", "four", "c", "TX"),
    )
    report = reports.hotspots_report(dmr, facilities, "2023").collect()
    # 2 x 3 readings make 6 pairs; their mean is factor * mean(2,4) * mean(1,2,3).
    assert (report[0].FACILITY_NAME, report[0].num_paired_measurements) == ("one", 6)
    assert report[0].average_daily_nitrogen_load_kg == round(3 * 2 * S.LOAD_FACTOR, 2)
    # Equal after rounding: ordered by the unrounded mean.
    assert [r.FACILITY_NAME for r in report] == ["one", "two", "three"]
    assert report[1].average_daily_nitrogen_load_kg == report[2].average_daily_nitrogen_load_kg
    assert len(reports.hotspots_report(dmr, facilities, "2023", rows=1).collect()) == 1


def test_industry_counts_null_loads_and_every_sector(rows):
    dmr = rows(
        READING,
        ("OH1", "d", N, None, "2023", "OH"),
        ("OH1", "d", N, "10", "2023", "OH"),
        ("OH1", "d", F_, "10", "2023", "OH"),
    )
    naics = rows(
        "NPDES_ID string, NAICS_DESC string, PRIMARY_INDICATOR_FLAG string",
        ("OH1", "a", "Y"), ("OH1", "a", "N"), ("OH1", "b", "N"),
    )
    report = {r.NAICS_DESC: r for r in reports.industry_load(dmr, naics, "2023").collect()}
    assert set(report) == {"a", "b"}
    assert report["a"].num_paired_measurements == 2
    assert report["a"].total_annual_load_kg == round(100 * S.LOAD_FACTOR)
    assert report["a"].avg_daily_load_per_report_kg == round(100 * S.LOAD_FACTOR)
    primary = reports.industry_load(dmr, naics, "2023", primary_only=True).collect()
    assert [r.NAICS_DESC for r in primary] == ["a"]


def test_regional_takes_the_year_of_the_concentration(rows):
    dmr = rows(
        READING,
        ("OH1", "09/30/2022", N, "1", "2022", "OH"),
        ("OH1", "09/30/2022", N, "2", "2023", "OH"),
        ("OH1", "09/30/2022", F_, "100", "2023", "OH"),
        ("TX1", "09/30/2022", N, "2", "2023", "TX"),
        ("TX1", "09/30/2022", F_, "2", "2023", "TX"),
    )
    report = reports.regional_timeseries(dmr, ["OH"]).orderBy(*reports.regional_order()).collect()
    assert [(r.year, r.state, r.total_annual_load_kg, r.num_paired_measurements) for r in report] == [
        ("2022", "OH", 379.0, 1),
        ("2023", "OH", 757.0, 1),
    ]


def undated_by_join(dmr, permits):
    number = clean.to_finite_text_number("DMR_VALUE_STANDARD_UNITS")
    key = "EXTERNAL_PERMIT_NMBR"
    n = dmr.filter(F.col("PARAMETER_DESC") == N).select(key, number.alias("n"))
    f = dmr.filter(F.col("PARAMETER_DESC") == F_).select(key, number.alias("f"), F.lit(True).alias("has"))
    joined = n.join(f, key, "left").join(permits, key, "left")
    flow = F.when(F.col("has"), F.col("f")).otherwise(F.col("ACTUAL_AVERAGE_FLOW_NMBR"))
    return joined.withColumn("flow", flow).dropna(subset=["n", "flow"]).groupBy(key).agg(
        F.avg(F.col("n") * F.col("flow") * S.LOAD_FACTOR)
    )


@pytest.mark.parametrize("seed", [7, 8])
def test_undated_load_equals_the_join(rows, seed):
    data = random_readings(seed, 60)
    only_n = [("OH9", "d", N, "2", "2023", "OH"), ("OH9", "d", N, "4", "2023", "OH"),
              ("TX9", "d", N, "4", "2023", "TX")]
    blank_flow = [("OH8", "d", N, "2", "2023", "OH"), ("OH8", "d", F_, None, "2023", "OH")]
    dmr = rows(READING, *[r for r in data if r[0]], *only_n, *blank_flow)
    permits = rows(
        "EXTERNAL_PERMIT_NMBR string, ACTUAL_AVERAGE_FLOW_NMBR double",
        ("OH9", 10.0), ("OH9", 20.0), ("OH9", None), ("OH8", 5.0), ("OH1", 7.0), ("OH1", 8.0),
    )
    got = paired.undated_mean_load(dmr, permits).select("EXTERNAL_PERMIT_NMBR", "mean_load").collect()
    assert same_rows(got, undated_by_join(dmr, permits).collect())
    found = {r[0]: r[1] for r in got}
    # No flow row: the recorded flows stand in. A blank flow row: nothing does.
    assert found["OH9"] == pytest.approx(3 * 15 * S.LOAD_FACTOR)
    assert "OH8" not in found and "TX9" not in found


def test_top_facilities_break_ties_by_permit(rows):
    dmr = rows(
        READING,
        *[(p, "d", q, "2", "2023", "OH") for p in ("OH3", "OH1", "OH2") for q in (N, F_)],
        *[("TX1", "d", q, "9", "2023", "TX") for q in (N, F_)],
    )
    permits = rows("EXTERNAL_PERMIT_NMBR string, ACTUAL_AVERAGE_FLOW_NMBR double", ("OH1", 1.0))
    top = reports.top_facilities_by_load(dmr, permits, "OH", N, F_, 2).collect()
    assert [r.EXTERNAL_PERMIT_NMBR for r in top] == ["OH1", "OH2"]

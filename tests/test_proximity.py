import random

import pytest
from pyspark.sql import functions as F

from rillgauge.operators import proximity

AD = "lat double, lon double"
SITE = "npdes string, lat double, lon double"


def brute_force(sites, ads, t=0.01):
    return {
        s[0] for s in sites for a in ads
        if s[1] and s[2] and a[0] and a[1] and abs(s[1] - a[0]) < t and abs(s[2] - a[1]) < t
    }


def matches(spark, sites, ads, t=0.01):
    found = proximity.matched_ids(spark.createDataFrame(sites, SITE), spark.createDataFrame(ads, AD), threshold=t)
    return [r.npdes for r in found.collect()]


def test_edges(spark):
    sites = [
        ("near", 40.0, -80.0), ("far", 40.0, -80.5), ("edge", 0.5, 10.0), ("across", 20.0049, -20.0),
        ("half", -33.005, -33.005), ("zero", 0.0, 5.0), ("null", None, 5.0), ("nan", float("nan"), 5.0),
    ]
    ads = [(40.0099, -80.0099), (0.51, 10.0), (20.0051, -20.0), (-33.0149, -32.9951), (0.001, 5.0), (0.0, 5.0)]
    found = matches(spark, sites, ads)
    assert sorted(found) == sorted(brute_force([s for s in sites if s[1] is not None], ads))
    assert "near" in found and "across" in found and "edge" not in found and "zero" not in found


@pytest.mark.parametrize("seed,span,digits", [(1, 0.2, 6), (2, 0.05, 6), (3, 0.03, 3), (4, 0.012, 4)])
def test_equals_brute_force(spark, seed, span, digits):
    """From sparse to crowded: the last ones put every location into a few cells."""
    rnd = random.Random(seed)

    def near(base):
        return round(base + rnd.uniform(-span, span), digits)

    sites = [(f"s{i}", near(-35.0), near(-80.005)) for i in range(250)]
    ads = [(near(-35.0), near(-80.005)) for _ in range(400 if span < 0.05 else 60)]
    found = matches(spark, sites, ads)
    assert len(found) == len(set(found))
    assert set(found) == brute_force(sites, ads)


@pytest.mark.parametrize("t", [0.003, 0.015, 0.03, 0.3, 0.6, 1.0])
def test_any_threshold(spark, t):
    rnd = random.Random(int(t * 1000))
    sites = [(f"s{i}", 10 + rnd.uniform(-3, 3) * t, 20 + rnd.uniform(-3, 3) * t) for i in range(200)]
    ads = [(10 + rnd.uniform(-3, 3) * t, 20 + rnd.uniform(-3, 3) * t) for _ in range(12)]
    sites += [(f"e{i}", a[0] - 0.9994 * t, a[1]) for i, a in enumerate(ads)]
    assert set(matches(spark, sites, ads, t)) == brute_force(sites, ads, t)


def test_threshold_must_fit_a_degree(spark):
    for t in (0.0, -1.0, 1.5):
        with pytest.raises(ValueError):
            matches(spark, [("s", 1.0, 1.0)], [(1.0, 1.0)], t)


def test_crowded_cell_shrinks(spark):
    """Many locations in one cell: only its outline takes part in the join."""
    rnd = random.Random(9)
    ads = [(40.0 + rnd.uniform(-0.0049, 0.0049), -80.0 + rnd.uniform(-0.0049, 0.0049)) for _ in range(5000)]
    kept = proximity.cell_outlines(spark.createDataFrame(ads, AD)).count()
    assert kept < 150


def test_copies_collapse(spark):
    ads = [(40.0, -80.0)] * 1000
    assert proximity.cell_outlines(spark.createDataFrame(ads, AD)).count() == 1


def test_modes(spark):
    sites = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 2.0)], SITE)
    matched = proximity.matched_ids(sites, spark.createDataFrame([(1.0, 1.001)], AD))

    def ids(mode):
        return sorted(r.npdes for r in proximity.keep_by_match(sites, matched, mode).collect())

    assert (ids("all"), ids("only"), ids("exclude")) == (["a", "b"], ["a"], ["b"])
    with pytest.raises(ValueError):
        proximity.keep_by_match(sites, matched, "some")
    flags = proximity.with_match_flag(sites, matched).select("npdes", F.col("is_ad")).collect()
    assert {tuple(f) for f in flags} == {("a", True), ("b", False)}

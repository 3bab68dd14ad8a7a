import random

import pytest
from pyspark.sql import functions as F

from helpers import N, reading, write_csv
from rillgauge import schemas as S
from rillgauge.operators import nested
from rillgauge.plans import extracts
from rillgauge.sources import scans, sinks


def facility(npdes, lat, lon, state):
    return {"NPDES_ID": npdes, "GEOCODE_LATITUDE": lat, "GEOCODE_LONGITUDE": lon, "STATE_CODE": state}


FACILITIES = [
    facility("OH1", "40.0", "-80.0", "OH"),
    facility("OH1", "41.0", "-81.0", "OH"),
    facility("OH1", "bad", "-82.0", "OH"),
    facility(" TX1 ", " 30.0 ", "-97.0", "TX"),
    facility("XX1", "1", "1", ""),
    facility("XX2", "", "1", "OH"),
]


def raw_inputs(spark, tmp_path, files):
    write_csv(tmp_path / "fac.csv", S.FACILITY_COLUMNS, FACILITIES)
    for label, records in files.items():
        write_csv(tmp_path / f"NPDES_DMRS_{label}.csv", S.DMR_COLUMNS, records)
    labels = [k.removeprefix("FY") for k in files]
    return (
        scans.scan_dmr(spark, str(tmp_path), labels),
        scans.scan_facilities(spark, str(tmp_path / "fac.csv")),
    )


def test_lookup_takes_the_last_valid_row(spark, tmp_path):
    _, facilities = raw_inputs(spark, tmp_path, {"FY2020": []})
    found = {r.npdes: (r.lat, r.lon, r.state) for r in extracts.facility_lookup(facilities).collect()}
    assert found == {"OH1": (41.0, -81.0, "OH"), "TX1": (30.0, -97.0, "TX")}


def test_site_records(spark, tmp_path):
    records = [
        reading("OH1", N, "02/29/2020", "2"),
        reading("OH1", N, "1/31/2020", " 1 ", DMR_UNIT_DESC="ug/L"),
        reading("OH1", N, "02/30/2020", "3"),
        reading("OH1", N, "2020-01-31", "3"),
        reading("OH1", N, "03/31/2020", "3", NODI_CODE="C"),
        reading("OH1", N, "03/31/2020", ""),
        reading("OH1", "", "03/31/2020", "<4"),
        reading("ZZ1", N, "03/31/2020", "4"),
    ]
    dmr, facilities = raw_inputs(spark, tmp_path, {"FY2020": records})
    found = {r.pollutant: r for r in extracts.site_measurements(dmr, facilities).collect()}
    assert set(found) == {N, ""}
    site = found[N]
    assert (site.label, site.state, site.npdes, site.lat, site.lon) == ("2020", "OH", "OH1", 41.0, -81.0)
    # Source order, not date order; the unit of the last kept row.
    assert [tuple(m) for m in site.measurements] == [("02/29/2020", "2"), ("1/31/2020", "1")]
    assert (site.unit, site.part) == ("ug/L", 0)
    assert [tuple(m) for m in found[""].measurements] == [("03/31/2020", "<4")]
    charted = extracts.site_measurements(dmr, facilities).select(nested.sorted_measurements().alias("m"))
    assert [(m.date, m.value) for r in charted.collect() for m in r.m if r.m[0].date != "03/31/2020"] == [
        ("1/31/2020", 1.0), ("02/29/2020", 2.0),
    ]


@pytest.mark.parametrize("by_month", [False, True])
def test_hot_keys_are_cut_by_calendar(spark, by_month):
    """One key holds a third of the rows; records hold one year or month, whatever the partitions."""
    rnd = random.Random(5)
    data = [
        ("hot" if i % 3 == 0 else f"k{rnd.randrange(60)}", f"{i % 12 + 1}/1/{2000 + i % 7}", str(i), f"u{i}", i)
        for i in range(3000)
    ]
    rnd.shuffle(data)
    rows = spark.createDataFrame(data, "npdes string, date string, value string, unit string, pos int")
    kept = []
    for parts in (1, 13):
        records = nested.nest_measurements(rows.repartition(parts), ["npdes"], by_month=by_month).collect()
        kept.append({(r.npdes, r.cal_year, r.part): ([m.value for m in r.measurements], r.unit) for r in records})
        assert len(kept[-1]) == len(records)
    expected = {}
    for key, date, value, unit, pos in sorted(data, key=lambda d: d[4]):
        month, _, year = date.split("/")
        values, _ = expected.get((key, year, int(month) if by_month else 0), ([], None))
        expected[key, year, int(month) if by_month else 0] = ([*values, value], unit)
    assert kept == [expected, expected]


def test_a_hot_key_year_is_dealt_over_tasks(spark, monkeypatch, request):
    """A third of the rows in one site and year: records of bounded size, in source order, and no task with all of them."""
    monkeypatch.setattr(nested, "CHUNK_ROWS", 50)
    n = 6000
    data = [("hot" if i % 3 == 0 else f"k{i % 500}", "1/1/2000", str(i), f"u{i}", ("f", 1000 * (i // 2000), i)) for i in range(n)]
    schema = "npdes string, date string, value string, unit string, pos struct<file:string,block:bigint,row:bigint>"
    rows = spark.createDataFrame(random.Random(2).sample(data, n), schema)
    whole = {r.npdes: ([m.value for m in r.measurements], r.unit, r.part) for r in nested.nest_measurements(rows, ["npdes"]).collect()}
    hot = [d for d in data if d[0] == "hot"]
    assert whole["hot"] == ([d[2] for d in hot], hot[-1][3], 0) and len(whole) == len({d[0] for d in data})
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # small tables would be merged again
    spark.conf.set(name, False)
    request.addfinalizer(lambda: spark.conf.unset(name))
    parts = nested.nest_measurements(rows, ["npdes"], record_rows=300)
    tasks = parts.where("npdes = 'hot'").groupBy(F.spark_partition_id().alias("task")).agg(F.sum(F.size("measurements")).alias("n"))
    assert max(r.n for r in tasks.collect()) < len(hot) * 0.75
    records = [r for r in parts.collect() if r.npdes == "hot"]
    assert max(len(r.measurements) for r in records) <= 300 + 50 and len(records) >= 5
    records.sort(key=lambda r: r.part)
    assert [r.part for r in records] == [100 * i for i in range(len(records))]
    assert [m.value for r in records for m in r.measurements] == whole["hot"][0] and records[-1].unit == hot[-1][3]
    others = {r.npdes: [m.value for m in r.measurements] for r in parts.collect() if r.npdes != "hot"}
    assert others == {k: v[0] for k, v in whole.items() if k != "hot"}


def site(npdes, pollutant, label, measurements, unit="mg/L", lat=40.0, lon=-80.0, state="OH"):
    return (npdes, pollutant, unit, lat, lon, measurements[0][0][-4:], 0, measurements, label, state)


def sites_frame(spark, *sites):
    return spark.createDataFrame(list(sites), S.SITE_RECORD)


def test_split_by_year(spark):
    sites = sites_frame(
        spark,
        site("A", "x/y, z", "PREFY2009", [("01/31/1999", "1"), ("02/28/1999", "3")]),
        site("A", "x/y, z", "PREFY2009", [("1/31/2001", "2")]),
        site("A", "x/y, z", "2010", [("10/31/2009", "4")]),
    )
    found = {(r.year, r.npdes, r.unit, r.safe_name): [m.value for m in r.measurements]
             for r in extracts.pollutant_measurements(sites).collect()}
    assert found == {
        ("1999", "A", None, "x-y_z"): ["1", "3"],
        ("2001", "A", None, "x-y_z"): ["2"],
        ("2010", "A", "mg/L", "x-y_z"): ["4"],
    }


def test_catalogue_and_lists(spark, tmp_path):
    sites = sites_frame(
        spark,
        site("A", "A/B", "2020", [("01/31/2020", "1")]),
        site("B", "A-B", "2020", [("01/31/2020", "1")]),
        site("B", "Nitrogen, total [as N]", "2021", [("01/31/2021", "1")]),
        site("C", "Old, one", "PREFY2009", [("01/31/99", "1")]),
    )
    pollutants = extracts.pollutant_measurements(sites)
    catalogue = [tuple(r) for r in extracts.pollutant_catalogue(pollutants).collect()]
    assert catalogue == [
        ("A-B.json", "A-B"), ("Nitrogen_total_[as_N].json", "Nitrogen total [as N]"),
        ("Old_one.json", "Old one"),
    ]
    # Only four-digit year folders count for the plain list.
    names = extracts.pollutant_names(pollutants)
    assert [r.name for r in names.collect()] == ["A-B", "Nitrogen_total_[as_N]"]
    sinks.write_list(names, str(tmp_path / "list"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "list").glob("part-*.txt")))
    assert text == "A-B\nNitrogen_total_[as_N]\n"
    clash = extracts.name_collisions(pollutants).collect()
    assert {tuple(r) for r in clash} == {("2020", "A-B", "A-B"), ("2020", "A-B", "A/B")}
    years = [r.year for r in extracts.catalogue_years(spark).orderBy("year").collect()]
    assert (years[0], years[-1], len(years)) == ("1983", "2025", 43)
    assert extracts.catalogue_states(spark).count() == 56


def test_json_round_trip(spark, tmp_path):
    sites = sites_frame(
        spark,
        site("A", "x", "2020", [("01/31/2020", "1")]),
        site("B", "y", "PREFY2009", [("01/31/1999", "1")], state="TX"),
    )
    path = str(tmp_path / "sites")
    for _ in range(2):
        sinks.write_site_json(sites, path)
    assert sorted(map(str, scans.read_site_json(spark, path).collect())) == sorted(map(str, sites.collect()))
    assert [r.npdes for r in scans.read_site_json(spark, path, label="2020").collect()] == ["A"]
    assert [r.npdes for r in scans.read_site_json(spark, path, states=["TX", "ZZ"]).collect()] == ["B"]
    pollutants = str(tmp_path / "pollutants")
    sinks.write_pollutant_json(extracts.pollutant_measurements(sites), pollutants)
    assert (tmp_path / "pollutants" / "year=1999" / "safe_name=y").is_dir()
    stored = scans.read_pollutant_json(spark, pollutants).collect()
    assert {(r.year, r.safe_name, r.unit) for r in stored} == {("2020", "x", "mg/L"), ("1999", "y", None)}


def test_site_view(spark):
    sites = sites_frame(
        spark,
        site("A", "x, y", "2022", [("12/31/2021", "2"), ("11/30/2021", "1")], unit="ug/L"),
        site("A", "x, y", "2022", [("01/31/2022", "3")]),
        site("A", "x, y", "2021", [("01/31/2021", "5"), ("12/31/2021", "6")]),
        site("A", "other", "2022", [("12/31/2021", "2")]),
        site("B", "x, y", "2021", [("01/31/2021", "7")], lat=41.0),
        site("C", "x, y", "2021", [("01/31/2021", "7")], lat=0.0, state="TX"),
        site("D", "x, y", "2021", [("01/31/2020", "7")]),
    )
    ads = spark.createDataFrame([(40.005, -80.005), (0.0, -80.0)], "lat double, lon double")

    def view(**options):
        rows = extracts.site_view(sites, ads, "2021", pollutant="x y", **options).collect()
        return {r.npdes: r for r in rows}

    found = view()
    assert set(found) == {"A", "B", "C"}
    assert [(m.date, m.value) for m in found["A"].measurements] == [
        ("01/31/2021", 5.0), ("11/30/2021", 1.0), ("12/31/2021", 6.0), ("12/31/2021", 2.0),
    ]
    assert found["A"].unit == "ug/L"
    assert (found["A"].is_ad, found["A"].site_class, found["B"].is_ad) == (True, "Anaerobic Digestion", False)
    assert (found["C"].is_ad, found["C"].on_map) == (False, False)
    assert set(view(ad_mode="only")) == {"A"}
    assert set(view(ad_mode="exclude")) == {"B", "C"}
    assert set(view(state="TX")) == {"C"}
    assert set(view(label_only=True)) == {"A", "B", "C"}
    assert len(view(label_only=True)["A"].measurements) == 2
    with pytest.raises(ValueError):
        view(ad_mode="some")
    assert extracts.site_count(extracts.site_view(sites, ads, "2021")).first().sites == 4


def test_view_reads_the_folders_of_its_year(spark, tmp_path):
    sites = sites_frame(
        spark,
        site("A", "x", "2022", [("12/31/2021", "2")]), site("A", "x", "2021", [("01/31/2021", "1")]),
        site("B", "x", "2020", [("01/31/2020", "1")], state="TX"),
    )
    path = str(tmp_path / "sites")
    sinks.write_sites(sites, path)
    ads = spark.createDataFrame([(40.005, -80.005)], "lat double, lon double")
    view = extracts.site_view(scans.read_sites(spark, path), ads, "2021", state="OH")
    assert [(r.npdes, len(r.measurements)) for r in view.collect()] == [("A", 2)]
    plan = view._jdf.queryExecution().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line and "cal_year" in line]
    assert filters and all("= 2021" in line and "= OH" in line for line in filters)


def test_pollutant_folders_come_from_the_listing(spark, tmp_path):
    names = ["a+b%", "x [as N]", "Nitrogen_total", "p:q"]
    sites = sites_frame(spark, *(site("A", n, "2020", [("01/31/2020", "1")]) for n in names))
    sinks.write_pollutant_json(extracts.pollutant_measurements(sites), str(tmp_path / "p"))
    found = scans.pollutant_folders(spark, str(tmp_path / "p"))
    stored = scans.read_pollutant_json(spark, str(tmp_path / "p")).select("year", "safe_name").distinct()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stored.collect()))


def test_nesting_stores_no_measurements_on_the_way(spark):
    """Only counts are written to scratch tables; the measurements are shuffled once, straight into records."""
    from rillgauge import session

    data = [(f"k{i % 7}", "1/1/2000", str(i), "u", i) for i in range(200)]
    rows = spark.createDataFrame(data, "npdes string, date string, value string, unit string, pos bigint")
    before = len(session._SCRATCH)
    records = nested.nest_measurements(rows, ["npdes"], record_rows=10)
    written = session._SCRATCH[before:]
    assert written
    for folder in written:
        stored = spark.read.parquet(folder + "/*")
        assert not {"entries", "value", "date"} & set(stored.columns), stored.columns
    got = {(r.npdes, r.part): [m.value for m in r.measurements] for r in records.collect()}
    assert sorted(int(v) for vs in got.values() for v in vs) == list(range(200))

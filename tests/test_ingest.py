import csv
import os
import random
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from helpers import F_, N, reading, write_csv
from rillgauge import schemas as S
from rillgauge.operators import inspect as inspector
from rillgauge.plans import ingest, reports
from rillgauge.sources import records, scans, sinks


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_csv(folder / "NPDES_DMRS_FY2023.csv", S.DMR_COLUMNS, [
        reading("OH1", N, "10/31/2022", "5"),
        reading("", 'x "quoted", y', "10/31/2022", ""),
        reading("TX2", F_, "01/31/2023", " 5 "),
    ])
    write_csv(folder / "NPDES_DMRS_PREFY2009.csv", S.DMR_COLUMNS, [
        reading("TX1", "A/B", f"01/31/{y}", "5") for y in (1999, 2000, 2000, 2001, 2010)
    ])
    return folder


def test_dmr_ingest(spark, raw, tmp_path):
    output = str(tmp_path / "dmr")
    assert ingest.ingest_dmr(spark, str(raw), output, 2000, 2024) == {"rows": 6, "malformed": 0}
    table = scans.read_dmr(spark, output)
    found = {
        (r.year, r.state, r.cal_year, r.label): r.n
        for r in table.groupBy("year", "state", "cal_year", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert found == {
        ("2023", "OH", 2022, "2023"): 1,
        ("2023", None, 2022, "2023"): 1,
        ("2023", "TX", 2023, "2023"): 1,
        ("2000", "TX", 2000, "PREFY2009"): 2,
        ("2001", "TX", 2001, "PREFY2009"): 1,
    }
    quoted = table.filter("state IS NULL").first()
    assert (quoted.PARAMETER_DESC, quoted.DMR_VALUE_NMBR) == ('x "quoted", y', None)


def test_ingest_again_replaces(spark, raw, tmp_path):
    output = str(tmp_path / "dmr")
    for _ in range(2):
        ingest.ingest_dmr(spark, str(raw), output, 1999, 2023)
    assert scans.read_dmr(spark, output).count() == 7
    write_csv(raw / "NPDES_DMRS_FY2023.csv", S.DMR_COLUMNS, [reading("OH1", N, "10/31/2022", "6")])
    ingest.ingest_dmr(spark, str(raw), output, 2023, 2023)
    table = scans.read_dmr(spark, output)
    assert [r.DMR_VALUE_NMBR for r in table.filter("year = '2023' AND state = 'OH'").collect()] == ["6"]
    assert table.filter("label = 'PREFY2009'").count() == 4


def test_absent_files_are_skipped(spark, raw, tmp_path):
    (raw / "archive").mkdir()
    good = (raw / "NPDES_DMRS_FY2023.csv").read_text()
    for name in ("archive/NPDES_DMRS_FY2015.csv", "NPDES_DMRS_2016.csv", "NPDES_DMRS_FY2017.csv.bak", "xNPDES_DMRS_FY2018.csv"):
        (raw / name).write_text(good)
    (raw / "NPDES_DMRS_FY2026.csv").mkdir()
    (raw / "NPDES_DMRS_FY2026.csv" / "part-0.csv").write_text(good)
    wanted = [str(y) for y in range(2015, 2024)]
    assert scans.present_labels(spark, str(raw), wanted) == ["2023"]
    assert scans.present_labels(spark, str(raw)) == ["PREFY2009", "2023", "2026"]
    assert scans.scan_dmr(spark, str(raw), ["2023", "2026"]).count() == 6
    assert ingest.ingest_dmr(spark, str(raw), str(tmp_path / "none"), 2011, 2012)["rows"] == 0


def test_scan_orders_rows_and_reads_label_folders(spark, tmp_path):
    folder = tmp_path / "NPDES_DMRS_FY2020.csv"
    folder.mkdir()
    for part in (0, 1):
        write_csv(folder / f"part-{part}.csv", S.DMR_COLUMNS,
                  [reading("OH1", N, "d", str(part * 10 + i)) for i in range(5)])
    scanned = scans.scan_dmr(spark, str(tmp_path), ["2020"])
    ordered = [r.DMR_VALUE_NMBR for r in scanned.orderBy("source_pos").collect()]
    assert ordered == [str(i) for i in (0, 1, 2, 3, 4, 10, 11, 12, 13, 14)]
    assert {r.label for r in scanned.collect()} == {"2020"}


def test_dimension_tables(spark, tmp_path):
    source = tmp_path / "f.csv"
    write_csv(source, S.FACILITY_COLUMNS, [
        {"NPDES_ID": "OH1", "STATE_CODE": "", "GEOCODE_LATITUDE": "40.5", "GEOCODE_LONGITUDE": "x"},
        {"NPDES_ID": "OH2", "STATE_CODE": "KY"},
        {"NPDES_ID": "", "STATE_CODE": ""},
    ])
    counts = ingest.ingest_facilities(spark, str(source), str(tmp_path / "facilities"))
    assert counts == {"rows": 3, "missing": 2, "fixed": 1, "still_missing": 1, "malformed": 0}
    stored = {r.NPDES_ID: r for r in scans.read_facilities(spark, str(tmp_path / "facilities")).collect()}
    assert (stored["OH1"].state, stored["OH1"].state_raw) == ("OH", None)
    assert (stored["OH1"].GEOCODE_LATITUDE, stored["OH1"].GEOCODE_LONGITUDE) == (40.5, None)
    assert (stored["OH2"].state, stored[None].state) == ("KY", None)

    write_csv(source, S.PERMIT_COLUMNS, [
        {"EXTERNAL_PERMIT_NMBR": "OH1", "PERMIT_TYPE_CODE": "NPD", "ACTUAL_AVERAGE_FLOW_NMBR": "1.5"},
        {"EXTERNAL_PERMIT_NMBR": "OH2", "PERMIT_TYPE_CODE": "", "ACTUAL_AVERAGE_FLOW_NMBR": ""},
    ])
    ingest.ingest_permits(spark, str(source), str(tmp_path / "permits"))
    permits = scans.read_permits(spark, str(tmp_path / "permits")).collect()
    assert {(p.EXTERNAL_PERMIT_NMBR, p.PERMIT_TYPE_CODE, p.ACTUAL_AVERAGE_FLOW_NMBR) for p in permits} == {
        ("OH1", "NPD", 1.5), ("OH2", None, None),
    }

    write_csv(source, S.NAICS_COLUMNS, [{"NPDES_ID": "OH1", "NAICS_DESC": "Sewage"}])
    ingest.ingest_naics(spark, str(source), str(tmp_path / "naics"))
    assert [(r.NPDES_ID, r.state) for r in scans.read_naics(spark, str(tmp_path / "naics")).collect()] == [
        ("OH1", "OH")
    ]


def test_ad_sites_by_position(spark, tmp_path):
    source = tmp_path / "ad.csv"
    names = [f"h{i}" for i in range(1, 16)]
    base = {n: 'a, "b"' for n in names}
    write_csv(source, names, [
        {**base, "h12": "40.5", "h13": "-80.25"}, {**base, "h12": "x", "h13": "1"}, {**base, "h12": ""},
    ])
    assert [tuple(r) for r in scans.scan_ad_sites(spark, str(source)).collect()] == [(40.5, -80.25)]


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_and_predicates_reach_the_scan(spark, rows, raw, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    output = str(tmp_path / "dmr")
    ingest.ingest_dmr(spark, str(raw), output, 1999, 2023)
    table = scans.read_dmr(spark, output)
    facilities = rows("NPDES_ID string, FACILITY_NAME string, CITY string, state string", ("OH1", "n", "c", "OH"))
    plan = physical_plan(reports.hotspots(table, facilities, "2023"))
    # One scan of the measurements: pairing needs no self-join, and reads few columns.
    assert plan.count("FileScan parquet") == 1
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "In(PARAMETER_DESC" in plan and "IsNotNull(DMR_VALUE_STANDARD_UNITS)" in plan
    columns = plan.split("ReadSchema: struct<")[1].split(">")[0].split(",")
    assert {c.split(":")[0] for c in columns} == {
        "EXTERNAL_PERMIT_NMBR", "PARAMETER_DESC", "MONITORING_PERIOD_END_DATE", "DMR_VALUE_STANDARD_UNITS",
    }
    plan = physical_plan(reports.regional_timeseries(table, ["OH", "TX"]))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    assert "PartitionFilters: [state#" in plan


def test_hot_folder_is_split_over_tasks(spark, tmp_path):
    """A state with most of the rows is written by several tasks, a small one by one."""
    df = spark.range(60_000).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 20 == 0, F.lit("TX")).otherwise(F.lit("OH")).alias("state"),
    )
    sinks.write_partitioned(df.repartition(8), str(tmp_path / "t"), ["state"], sort=["text"], file_bytes=200_000)
    files = {s: len(list((tmp_path / "t" / f"state={s}").glob("part-*"))) for s in ("OH", "TX")}
    assert files["OH"] >= 4 and files["TX"] == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_inspector(rows):
    df = rows("k int, v double, s string, y string", (1, 0.5, "a", "2020"), (2, 1.5, "b", "2021"), (3, None, "b", "2021"))
    assert [r.k for r in inspector.inspect(df, filters=[("v", ">", "0.6")]).collect()] == [2]
    assert [r.k for r in inspector.inspect(df, filters=[("y", "=", 2021), ("s", "!=", "a")], rows=1).collect()] == [2]
    assert inspector.inspect(df, columns=["s", "zz"]).columns == ["s"]
    with pytest.raises(ValueError):
        inspector.inspect(df, columns=["zz"])
    with pytest.raises(ValueError):
        inspector.inspect(df, filters=[("k", "~", 1)])
    picked = inspector.inspect(df, filters=[("k", "in", [1, 3]), ("s", "not in", ["a"])])
    assert [r.k for r in picked.collect()] == [3]


def test_report_is_one_sorted_file(spark, rows, tmp_path):
    df = rows("name string, load double", *[(f"n{i:03d}", float(i % 50)) for i in range(300)])
    path = str(tmp_path / "report")
    sinks.write_report(df, path, [F.col("load").desc(), F.col("name")], limit=200)
    parts = list((tmp_path / "report").glob("part-*.csv"))
    assert len(parts) == 1
    lines = parts[0].read_text().splitlines()
    assert (lines[0], lines[1], len(lines)) == ("name,load", "n049,49.0", 201)
    sinks.write_report(df, path, [F.col("name")])
    parts = list((tmp_path / "report").glob("part-*.csv"))
    assert len(parts) == 1 and len(parts[0].read_text().splitlines()) == 301


def test_runs_are_kept_apart(spark, rows, tmp_path):
    path = str(tmp_path / "runs")
    sinks.write_run(rows("x int", (1,)), path, "a")
    sinks.write_run(rows("x int", (2,)), path, "b")
    sinks.write_run(rows("x int", (3,)), path, "a")
    stored = spark.read.schema("x int, run string").parquet(path).collect()
    assert sorted((r.run, r.x) for r in stored) == [("a", 3), ("b", 2)]


def test_malformed_lines_are_counted(spark, raw, tmp_path):
    path = raw / "NPDES_DMRS_FY2022.csv"
    write_csv(path, S.DMR_COLUMNS, [reading("OH1", N, "10/31/2021", str(i)) for i in range(20)])
    extra = ",".join(["x"] * (len(S.DMR_COLUMNS) + 3))
    broken = ",".join(['"a\nb"', *["y"] * (len(S.DMR_COLUMNS) - 1)])
    path.write_bytes(path.read_bytes() + f"OH1,two\n{extra}\n{broken}\n".encode())
    output = str(tmp_path / "dmr")
    found = ingest.ingest_dmr(spark, str(raw), output, 2022, 2022, max_malformed=0.5)
    assert found == {"rows": 21, "malformed": 2}
    # A refused file leaves the stored rows as they are, and nothing beside them.
    before = sorted(map(str, scans.read_dmr(spark, output).collect()))
    path.write_bytes(path.read_bytes() + b"OH1,bad\n" * 30)
    with pytest.raises(ValueError, match="malformed"):
        ingest.ingest_dmr(spark, str(raw), output, 2022, 2022)
    assert sorted(map(str, scans.read_dmr(spark, output).collect())) == before
    assert not [p.name for p in (tmp_path / "dmr").iterdir() if p.name.startswith(sinks.STAGED)]


def test_a_source_without_a_good_line(spark, tmp_path):
    source, output = tmp_path / "n.csv", str(tmp_path / "n")
    write_csv(source, S.NAICS_COLUMNS, [])
    assert ingest.ingest_naics(spark, str(source), output) == {"rows": 0, "malformed": 0}
    source.write_text(source.read_text() + "a,b\n" * 40)
    with pytest.raises(ValueError, match="40 of 40"):
        ingest.ingest_naics(spark, str(source), output)


@pytest.mark.parametrize("ingest_one, columns", [
    (ingest.ingest_facilities, S.FACILITY_COLUMNS), (ingest.ingest_permits, S.PERMIT_COLUMNS), (ingest.ingest_naics, S.NAICS_COLUMNS),
])
def test_malformed_lines_of_dimensions(spark, tmp_path, ingest_one, columns):
    source, output = tmp_path / "d.csv", str(tmp_path / "d")
    key = "EXTERNAL_PERMIT_NMBR" if "EXTERNAL_PERMIT_NMBR" in columns else "NPDES_ID"
    write_csv(source, columns, [{key: f"OH{i}", columns[-1]: 'in "two"\nlines'} for i in range(5)])
    source.write_text(source.read_text() + "x,y\n")
    with pytest.raises(ValueError, match="1 of 11 lines"):
        ingest_one(spark, str(source), output)
    counts = ingest_one(spark, str(source), output, max_malformed=0.1)
    assert (counts["rows"], counts["malformed"]) == (5, 1)
    stored = spark.read.parquet(output).select(key, columns[-1]).collect()
    assert {tuple(r) for r in stored} == {(f"OH{i}", 'in "two"\nlines') for i in range(5)}


def csv_records(path):
    with open(path, newline="", encoding="utf-8", errors="replace") as file:
        return [[x.replace("\r\n", "\n") or None for x in r] for r in csv.reader(file)][1:]


@pytest.mark.parametrize("split", [None, 64, 190, 1000])
def test_records_with_line_breaks_equal_a_plain_reader(spark, tmp_path, split):
    """Fields with line breaks, quotes and blank lines in them, in files cut into splits of any size."""
    rng = random.Random(split or 7)
    columns = ["a", "b", "c"]

    def field():
        return rng.choice(["x", "", "a,b", 'say ""hi""', "one\ntwo", "\n", "\n\n", 'q""\n""', "é" * 9, "\ntail", "long " * 8, "\r\nend"])

    files = []
    for name, n in (("one.csv", 40), ("two.csv", 25), ("plain.csv", 30)):
        body = [",".join(f'"{field()}"' for _ in columns) for _ in range(n)]
        if name == "plain.csv":
            body = [f"{i},y,z" for i in range(n)]
        head = 'a,"b\nb",c' if name == "two.csv" else "a,b,c"
        files.append(tmp_path / name)
        files[-1].write_text("\n".join([head, *body]) + rng.choice(["", "\n"]), encoding="utf-8", newline="")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        if split:
            spark.conf.set(name, str(split))
        found = scans._scan(spark, [str(f) for f in files], columns, True, F.col("source_pos"), F.col("path"))
        got = found.orderBy("source_pos").collect()
    finally:
        spark.conf.set(name, before)
    assert not [r for r in got if r.malformed]
    for file in files:
        mine = [[r.a, r.b, r.c] for r in got if r.path.endswith(file.name)]
        # Rows of blank fields alone are lines too; blank lines are none.
        assert mine == csv_records(file), file.name
    assert sum(r.n_lines for r in got) == sum(len(f.read_text().splitlines()) for f in files) - 4


def test_a_stray_quote_spoils_its_own_line(spark, tmp_path):
    source = tmp_path / "s.csv"
    body = [f"{i},y,z" for i in range(30)]
    body[3], body[20], body[21] = '3,"stray,z', '20,"two', 'lines",z'
    source.write_text("\n".join(["a,b,c", *body]) + "\n")
    every = records.lines(spark, [str(source)])
    found = records.assembled(every, records.surveyed(every), most_lines=5).collect()
    assert sorted((r.text, r.stray, r.n_lines) for r in found if r.stray or r.n_lines > 1) == [
        ('20,"two\nlines",z', False, 2), ('3,"stray,z', True, 1),
    ]
    assert len(found) == 29


def test_a_good_field_may_begin_or_end_with_a_quote(spark, raw, tmp_path):
    path = raw / "NPDES_DMRS_FY2022.csv"
    write_csv(path, S.DMR_COLUMNS, [reading("OH1", N, "10/31/2021", "1", ACTIVITY_ID='5" pipe', RNC_RESOLUTION_DATE='"x')])
    assert ingest.ingest_dmr(spark, str(raw), str(tmp_path / "dmr"), 2022, 2022) == {"rows": 1, "malformed": 0}
    row = scans.read_dmr(spark, str(tmp_path / "dmr")).first()
    assert (row.ACTIVITY_ID, row.RNC_RESOLUTION_DATE) == ('5" pipe', '"x')


@pytest.mark.parametrize("moment", ["before the mark", "while moving", "between a folder's two moves"])
def test_a_killed_run_leaves_old_rows_or_new_ones(spark, rows, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "t")
    old = rows("k string, v int", ("a", 1), ("b", 2), ("c", 3))
    sinks.publish_partitioned(old, path, ["k"])
    new = rows("k string, v int", ("a", 10), ("b", 20), ("d", 40))

    class Killed(BaseException):
        pass

    place, moved = sinks._put_in_place, []

    def killed(spark, path, staged):
        if moment == "before the mark":
            raise AssertionError
        folders = sorted(sinks._partition_folders(spark, staged))
        monkeypatch.setattr(sinks, "_partition_folders", lambda *a: iter(folders[:1]))
        system, root = sinks.file_system(spark, staged)
        if moment == "while moving":
            with monkeypatch.context() as m:
                m.setattr(sinks, "file_system", lambda *a: (Kept(system), root))
                place(spark, path, staged)
        else:
            system.mkdirs(sinks._child(spark, f"{staged}/{sinks.REPLACED}"))
            system.rename(sinks._child(spark, f"{path}{folders[0]}"), sinks._child(spark, f"{staged}/{sinks.REPLACED}{folders[0]}"))
        moved.append(staged)
        raise Killed

    class Kept:
        """A file system on which nothing is removed any more."""

        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            return (lambda *a: True) if name == "delete" else getattr(self.system, name)

    def refuse():
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(sinks, "_put_in_place", killed)
        with pytest.raises(Killed):
            sinks.publish_partitioned(new, path, ["k"], accept=refuse if moment == "before the mark" else None)
    monkeypatch.undo()
    sinks.finish_publishing(spark, path)
    stored = {(r.k, r.v) for r in spark.read.schema("v int, k string").parquet(path).collect()}
    assert stored == ({("a", 1), ("b", 2), ("c", 3)} if not moved else {("a", 10), ("b", 20), ("c", 3), ("d", 40)})
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith(sinks.STAGED)]


def test_writes_side_by_side_keep_the_session_setting(spark, rows, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: sinks.write_partitioned(rows("k int, v int", (i, i)), str(tmp_path / f"w{i}"), ["k"], file_bytes=1000 + i), range(4)))
    assert spark.conf.get(name) == before


def test_bad_bytes_are_replaced(spark, raw, tmp_path):
    path = raw / "NPDES_DMRS_FY2022.csv"
    write_csv(path, S.DMR_COLUMNS, [reading("OH1", "caf?", "10/31/2021", "1")])
    path.write_bytes(path.read_bytes().replace(b"caf?", b"caf\xe9"))
    assert ingest.ingest_dmr(spark, str(raw), str(tmp_path / "dmr"), 2022, 2022)["rows"] == 1
    assert scans.read_dmr(spark, str(tmp_path / "dmr")).first().PARAMETER_DESC == "caf\ufffd"


def test_counts_of_permits_and_codes(spark, tmp_path):
    write_csv(tmp_path / "naics.csv", S.NAICS_COLUMNS, [{"NPDES_ID": "OH1"}, {"NPDES_ID": "TX1"}])
    assert ingest.ingest_naics(spark, str(tmp_path / "naics.csv"), str(tmp_path / "naics")) == {"rows": 2, "malformed": 0}


def test_measured_bytes_sees_nested_text(spark):
    from rillgauge.operators.sizing import measured_bytes

    df = spark.range(100).select(F.struct(F.lit("x" * 500).alias("t")).alias("s"), F.array(F.lit("y" * 300)).alias("a"))
    assert measured_bytes(df) > 80_000
    assert measured_bytes(spark.createDataFrame([(None, None)], "s struct<t:string>, a array<string>")) > 0


def test_shared_folder_is_required(spark):
    from rillgauge import session

    named = spark.conf.get("spark.checkpoint.dir")
    path = session.scratch_path(spark, "t")
    spark.range(1).write.parquet(path)
    assert path.startswith(named)
    session.release(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def shuffled_bytes(spark):
    folders = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return sum(os.path.getsize(os.path.join(d, f)) for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_"))


def test_partitioned_write_leaves_no_shuffle_files(spark, tmp_path):
    """The shuffled rows of a write go when it ends; the settings are as before."""
    before = {n: spark.conf.get(n, None) for n in (sinks.CLEANUP, "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    held = shuffled_bytes(spark)
    sinks.write_partitioned(spark.range(200_000).selectExpr("id % 5 AS k", "uuid() AS v"), str(tmp_path / "t"), ["k"], ["v"])
    for _ in range(50):
        if shuffled_bytes(spark) <= held:
            break
        time.sleep(0.1)
    assert shuffled_bytes(spark) <= held
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000
    assert before == {n: spark.conf.get(n, None) for n in before}


def test_compressed_sources(spark, tmp_path):
    """A label's folder of compressed part files, one with a line break in a field, gives the rows of plain ones."""
    names = S.DMR_COLUMNS
    data = [tuple(f"{c} {i}" + ("\nmore" if i == 3 and c == names[-1] else "") for c in names) for i in range(40)]
    rows = spark.createDataFrame(data, S.text_schema(S.DMR_COLUMNS)).repartition(3)
    got = []
    for codec in ("none", "gzip"):
        folder = str(tmp_path / codec)
        rows.write.options(header=True, quoteAll=True, escape='"', compression=codec, maxRecordsPerFile=7).csv(scans.source_path(folder, "2024"))
        assert scans.present_labels(spark, folder, ["2024"]) == ["2024"]
        found = scans.scan_dmr(spark, folder, ["2024"], checked=True).drop("source_pos").collect()
        assert all(r.malformed is None and r.label == "2024" for r in found)
        got.append(sorted(tuple(r[n] for n in names) for r in found))
    assert got[0] == got[1] == sorted(data)


def test_built_sources_take_little_disk(spark, tmp_path):
    """Sources that are mostly blank fields are stored compressed."""
    from analogues import stored

    rows = spark.range(20_000).select(F.col("id").cast("string").alias("EXTERNAL_PERMIT_NMBR"))
    path = scans.source_path(str(tmp_path), "2024")
    stored._as_csv(rows, S.DMR_COLUMNS, path)
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) < 20_000 * 20
    assert scans.scan_dmr(spark, str(tmp_path), ["2024"]).select("EXTERNAL_PERMIT_NMBR").distinct().count() == 20_000

"""The jobs chained through their command lines, from raw files to the map view."""

import json

from helpers import F_, N, reading, write_csv
from rillgauge import schemas as S
from rillgauge.cli import main


def read_json(folder):
    return [json.loads(line) for p in sorted(folder.rglob("part-*.json")) for line in p.read_text().splitlines()]


def read_report(folder):
    parts = list(folder.glob("part-*.csv"))
    assert len(parts) == 1
    return parts[0].read_text().splitlines()


def test_jobs_end_to_end(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_csv(raw / "NPDES_DMRS_FY2023.csv", S.DMR_COLUMNS, [
        reading(p, q, "01/31/2023", v) for p in ("OH1", "TX1") for q, v in ((N, "2"), (F_, "3"))
    ])
    write_csv(raw / "NPDES_DMRS_PREFY2009.csv", S.DMR_COLUMNS, [reading("OH1", "A/B", "01/31/1999", "1")])
    write_csv(raw / "ICIS_FACILITIES.csv", S.FACILITY_COLUMNS, [
        {"NPDES_ID": i, "FACILITY_NAME": f"plant {i}", "CITY": "c", "STATE_CODE": i[:2],
         "GEOCODE_LATITUDE": lat, "GEOCODE_LONGITUDE": "-80"} for i, lat in (("OH1", "40"), ("TX1", "30"))
    ])
    write_csv(raw / "naics.csv", S.NAICS_COLUMNS, [{"NPDES_ID": "OH1", "NAICS_DESC": "Sewage"}])
    write_csv(raw / "ad.csv", [f"h{i}" for i in range(1, 14)], [{"h12": "40.001", "h13": "-80.001"}])

    def run(*argv):
        main([str(a) for a in argv], spark)

    dmr, facilities, naics = tmp_path / "dmr", tmp_path / "facilities", tmp_path / "naics"
    run("ingest-dmr", raw, dmr, "--start-year", 1998, "--end-year", 2023)
    run("ingest-facilities", raw / "ICIS_FACILITIES.csv", facilities)
    run("ingest-naics", raw / "naics.csv", naics)
    run("hotspots", dmr, facilities, tmp_path / "hot", "--year", "2023")
    assert read_report(tmp_path / "hot")[1:] == ["plant OH1,c,OH,22.71,1", "plant TX1,c,TX,22.71,1"]
    run("industry", dmr, naics, tmp_path / "ind", "--year", "2023")
    assert read_report(tmp_path / "ind")[1:] == ["Sewage,23.0,23.0,1"]
    run("timeseries", dmr, tmp_path / "series", "--states", "TX", "OH")
    assert read_report(tmp_path / "series")[1:] == ["2023,OH,23.0,1", "2023,TX,23.0,1"]
    run("hotspots", dmr, facilities, tmp_path / "none", "--year", "2001")

    sites, pollutants = tmp_path / "sites", tmp_path / "pollutants"
    run("site-extract", raw, sites, "--json", tmp_path / "export")
    assert len(read_json(tmp_path / "export" / "label=2023" / "state=OH")) == 2
    run("pollutant-extract", sites, pollutants)
    run("catalogue", pollutants, tmp_path / "menu")
    menu = [r["filename"] for r in read_json(tmp_path / "menu" / "pollutants")]
    assert menu == ["A-B.json", "Flow_in_conduit_or_thru_treatment_plant.json", "Nitrogen_total_[as_N].json"]
    run("pollutant-names", pollutants, tmp_path / "names")
    run("site-view", sites, raw / "ad.csv", tmp_path / "view", "--year", "2023", "--pollutant", "Nitrogen total [as N]")
    assert {(r["npdes"], r["is_ad"]) for r in read_json(tmp_path / "view")} == {("OH1", True), ("TX1", False)}

    capsys.readouterr()
    run("inspect", dmr, "-c", "state", "PARAMETER_DESC", "-f", "year", "=", "1999", "-n", 5)
    assert "A/B" in capsys.readouterr().out
    run("inspect", dmr, "-c", "state", "-f", "state", "in", "TX, ZZ")
    assert "OH" not in capsys.readouterr().out.split("state")[-1]

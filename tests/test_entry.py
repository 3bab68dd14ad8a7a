"""Contract of the entry module, and a value check of the cheap queries on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract

TABLES = "/root/testdata/sf0.001"
have_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables not present")


def test_names_agree():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    own = {case.name for case in contract.CASES}
    assert own <= set(sql)


def cell(v):
    if v is None:
        return None
    return f"{v:.10g}" if isinstance(v, float) else str(v)


@have_tables
@pytest.mark.parametrize("name", [
    "paired_load_by_key", "paired_load_by_sector", "paired_load_by_period_region", "undated_mean_load",
    "daily_resample_ffill", "monthly_features", "nested_in_parts", "explode_by_year", "proximity_flag",
    "site_view_only_matched", "site_view_two_labels", "site_view_of_state", "site_view_label_only", "proximity_wide",
    "name_catalogue", "try_parse", "gbt_forecast", "gbt_facility_forecasts", "empty_report", "name_list_stored",
    "line_break_round_trip", "refused_ingest_keeps_rows", "menus_stored", "reports_by_year_stored",
])
def test_equals_plain_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(TABLES):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{TABLES}/{file}'")
    df = contract.queries()[name](spark, TABLES)
    columns = sorted(df.columns)
    relation = con.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = sorted([tuple(cell(r[i]) for i in order) for r in relation.fetchall()], key=repr)
    assert sorted([tuple(cell(r[c]) for c in columns) for r in df.collect()], key=repr) == expected


@have_tables
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "FACILITY_NAME" and df.count() >= 0


def test_entry_without_the_corpus_operators():
    """Without the subpackage, or a library that it needs, the other queries are registered."""
    import subprocess
    import sys

    script = (
        "import sys, warnings\nsys.modules[{name!r}] = None\nwith warnings.catch_warnings(record=True) as said:\n"
        "    warnings.simplefilter('always')\n    import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline'], list(e.queries())\n"
        "assert len(e.queries()) == len(e.CASES) and len(said) >= 1\n"
    )
    root = os.path.dirname(os.path.abspath(contract.__file__))
    for name in ("rillgauge.llm", "public_tokenizers", "zstandard"):
        subprocess.run([sys.executable, "-c", script.format(name=name)], cwd=root, check=True)

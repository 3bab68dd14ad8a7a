import datetime

from rillgauge.functions import clean
from rillgauge.sources import scans
from pyspark.sql import functions as F


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_numbers(rows):
    df = rows("v string", ("",), ("<0.5",), ("1e3",), (" 5 ",), (None,), ("5d",), ("nan",), ("1.f",))
    assert values(df, clean.to_number("v"))[:5] == [None, None, 1000.0, 5.0, None]
    assert values(df, clean.to_finite_text_number("v")) == [
        None, None, 1000.0, 5.0, None, None, None, None,
    ]


def test_period_dates(rows):
    df = rows("d string", ("1/2/2020",), ("02/30/2020",), ("2020-01-02",), ("01/02/20",),
              ("001/02/2020",), ("12/31/1999",), (None,))
    jan, dec = datetime.date(2020, 1, 2), datetime.date(1999, 12, 31)
    assert values(df, clean.to_period_date("d")) == [jan, None, None, None, None, dec, None]


def test_trim_is_unicode(rows):
    df = rows("v string", ("  a b\t　",), (" \n",), (None,))
    assert values(df, clean.blank_to_null("v")) == ["a b", None, None]


def test_names(rows):
    df = rows("p string", ("A/B",), ("A-B",), ("Nitrogen, total [as N]",), ("x, y, z",), ("",), (None,))
    safe = ["A-B", "A-B", "Nitrogen_total_[as_N]", "x_y_z", "unnamed_pollutant", "unnamed_pollutant"]
    assert values(df, clean.safe_name("p")) == safe
    files = rows("f string", ("Nitrogen_total_[as_N].json",), ("Temp._rate.json.json",))
    assert values(files, clean.display_name("f")) == ["Nitrogen total [as N]", "Temp. rate.json"]


def test_states_and_labels(rows):
    df = rows("s string, id string", ("", "OH123"), ("TX", "OH1"), (None, ""), (" ", None))
    assert values(df, clean.backfilled_state("s", "id")) == ["OH", "TX", None, None]
    years = rows("y string", ("1983",), ("2008",), ("2009",), ("2025",))
    assert values(years, clean.label_of_year("y")) == ["PREFY2009", "PREFY2009", "2009", "2025"]
    dates = rows("d string", ("10/31/2022",), ("bad",), ("",))
    assert values(dates, clean.year_suffix("d")) == ["2022", None, None]


def test_file_labels(rows):
    df = rows("p string", ("/in/NPDES_DMRS_FY2023.csv",), ("/in/NPDES_DMRS_PREFY2009.csv",),
              ("/in/NPDES_DMRS_FY2011.csv/part-00001.csv",), ("/in/other.csv",))
    assert values(df, scans.file_label(F.col("p"))) == ["2023", "PREFY2009", "2011", None]
    assert scans.labels_for_years(2007, 2010) == ["PREFY2009", "2009", "2010"]
    assert scans.labels_for_years(2011, 2012) == ["2011", "2012"]

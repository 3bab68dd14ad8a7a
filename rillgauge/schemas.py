"""Schemas and constants of the monitoring tables.

Raw CSV scans read every column as text; the two tables that hold numbers get
them by an explicit, failure-tolerant cast at ingest.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The published column order of each source file. Names are
# applied by position and the header line is skipped.
DMR_COLUMNS = [
    "ACTIVITY_ID", "EXTERNAL_PERMIT_NMBR", "VERSION_NMBR", "PERM_FEATURE_ID", "PERM_FEATURE_NMBR",
    "PERM_FEATURE_TYPE_CODE", "LIMIT_SET_ID", "LIMIT_SET_DESIGNATOR", "LIMIT_SET_SCHEDULE_ID",
    "LIMIT_ID", "LIMIT_BEGIN_DATE", "LIMIT_END_DATE", "NMBR_OF_SUBMISSION", "NMBR_OF_REPORT",
    "PARAMETER_CODE", "PARAMETER_DESC", "MONITORING_LOCATION_CODE", "STAY_TYPE_CODE",
    "LIMIT_VALUE_ID", "LIMIT_VALUE_TYPE_CODE", "LIMIT_VALUE_NMBR", "LIMIT_UNIT_CODE",
    "LIMIT_UNIT_DESC", "STANDARD_UNIT_CODE", "STANDARD_UNIT_DESC", "LIMIT_VALUE_STANDARD_UNITS",
    "STATISTICAL_BASE_CODE", "STATISTICAL_BASE_TYPE_CODE", "LIMIT_VALUE_QUALIFIER_CODE",
    "OPTIONAL_MONITORING_FLAG", "LIMIT_SAMPLE_TYPE_CODE", "LIMIT_FREQ_OF_ANALYSIS_CODE",
    "STAY_VALUE_NMBR", "LIMIT_TYPE_CODE", "DMR_EVENT_ID", "MONITORING_PERIOD_END_DATE",
    "DMR_SAMPLE_TYPE_CODE", "DMR_FREQ_OF_ANALYSIS_CODE", "REPORTED_EXCURSION_NMBR",
    "DMR_FORM_VALUE_ID", "VALUE_TYPE_CODE", "DMR_VALUE_ID", "DMR_VALUE_NMBR", "DMR_UNIT_CODE",
    "DMR_UNIT_DESC", "DMR_VALUE_STANDARD_UNITS", "DMR_VALUE_QUALIFIER_CODE", "VALUE_RECEIVED_DATE",
    "DAYS_LATE", "NODI_CODE", "EXCEEDENCE_PCT", "NPDES_VIOLATION_ID", "VIOLATION_CODE",
    "RNC_DETECTION_CODE", "RNC_DETECTION_DATE", "RNC_RESOLUTION_CODE", "RNC_RESOLUTION_DATE",
]

FACILITY_COLUMNS = [
    "ICIS_FACILITY_INTEREST_ID", "NPDES_ID", "FACILITY_UIN", "FACILITY_TYPE_CODE", "FACILITY_NAME",
    "LOCATION_ADDRESS", "SUPPLEMENTAL_ADDRESS_TEXT", "CITY", "COUNTY_CODE", "STATE_CODE", "ZIP",
    "GEOCODE_LATITUDE", "GEOCODE_LONGITUDE", "IMPAIRED_WATERS",
]

PERMIT_COLUMNS = [
    "ACTIVITY_ID", "EXTERNAL_PERMIT_NMBR", "VERSION_NMBR", "FACILITY_TYPE_INDICATOR",
    "PERMIT_TYPE_CODE", "MAJOR_MINOR_STATUS_FLAG", "PERMIT_STATUS_CODE", "TOTAL_DESIGN_FLOW_NMBR",
    "ACTUAL_AVERAGE_FLOW_NMBR", "STATE_WATER_BODY", "STATE_WATER_BODY_NAME", "PERMIT_NAME",
    "AGENCY_TYPE_CODE", "ORIGINAL_ISSUE_DATE", "ISSUE_DATE", "ISSUING_AGENCY", "EFFECTIVE_DATE",
    "EXPIRATION_DATE", "RETIREMENT_DATE", "TERMINATION_DATE", "PERMIT_COMP_STATUS_FLAG",
    "DMR_NON_RECEIPT_FLAG", "RNC_TRACKING_FLAG", "MASTER_EXTERNAL_PERMIT_NMBR",
    "TMDL_INTERFACE_FLAG", "EDMR_AUTHORIZATION_FLAG", "PRETREATMENT_INDICATOR_CODE",
    "RAD_WBD_HUC12S",
]

NAICS_COLUMNS = ["NPDES_ID", "NAICS_CODE", "NAICS_DESC", "PRIMARY_INDICATOR_FLAG"]

# Columns held as numbers once stored.
FACILITY_NUMBERS = ("GEOCODE_LATITUDE", "GEOCODE_LONGITUDE")
PERMIT_NUMBERS = ("TOTAL_DESIGN_FLOW_NMBR", "ACTUAL_AVERAGE_FLOW_NMBR")

# Names, units and limits the reports are defined by.
N_PARAM = "Nitrogen, total [as N]"
F_PARAM = "Flow, in conduit or thru treatment plant"
LOAD_FACTOR = 3.78541  # mg/L x MGD -> kg/day
CONCENTRATION_UNIT = "mg/L"
FIRST_SINGLE_YEAR = 2009  # earlier years share one consolidated file
EARLY_LABEL = "PREFY2009"
PERIOD_FORMAT = "M/d/yyyy"
PROXIMITY_DEGREES = 0.01
CATALOGUE_FIRST_YEAR = 1983
CATALOGUE_LAST_YEAR = 2025

# State and territory codes of the selection menu.
STATE_CODES = [
    "AK", "AL", "AR", "AS", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "GU", "HI", "IA", "ID",
    "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MP", "MS", "MT", "NC", "ND",
    "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "PR", "RI", "SC", "SD", "TN", "TX",
    "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY",
]


def text_schema(columns: list[str]) -> T.StructType:
    """All-text schema in file order."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _stored(columns: list[str], numbers: tuple[str, ...] = ()) -> list[T.StructField]:
    return [
        T.StructField(name, T.DoubleType() if name in numbers else T.StringType())
        for name in columns
    ]


SOURCE_POS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)

# Stored tables. Partition columns come last and are declared as text, so a
# directory such as year=2015 is never re-typed as an integer.
DMR_TABLE = T.StructType(
    _stored(DMR_COLUMNS)
    + [
        T.StructField("label", T.StringType()),
        T.StructField("cal_year", T.IntegerType()),
        T.StructField("source_pos", SOURCE_POS),
        T.StructField("year", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

FACILITY_TABLE = T.StructType(
    _stored([c for c in FACILITY_COLUMNS if c != "STATE_CODE"], FACILITY_NUMBERS)
    + [
        T.StructField("state_raw", T.StringType()),
        T.StructField("source_pos", SOURCE_POS),
        T.StructField("state", T.StringType()),
    ]
)

PERMIT_TABLE = T.StructType(
    _stored([c for c in PERMIT_COLUMNS if c != "PERMIT_TYPE_CODE"], PERMIT_NUMBERS)
    + [T.StructField("PERMIT_TYPE_CODE", T.StringType())]
)

NAICS_TABLE = T.StructType(
    _stored(NAICS_COLUMNS) + [T.StructField("state", T.StringType())]
)

MEASUREMENT = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("value", T.StringType())]
)

SITE_RECORD = T.StructType(
    [
        T.StructField("npdes", T.StringType()),
        T.StructField("pollutant", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("cal_year", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("measurements", T.ArrayType(MEASUREMENT)),
        T.StructField("label", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

POLLUTANT_RECORD = T.StructType(
    [f for f in SITE_RECORD.fields if f.name not in ("label", "state")]
    + [T.StructField("year", T.StringType()), T.StructField("safe_name", T.StringType())]
)

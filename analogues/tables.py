"""The given tables seen as monitoring tables.

``events`` is one month of dense readings: a user is a permit, an event type a
parameter. ``lineitem`` holds years of readings: a supplier is a permit, a return
flag a parameter. Every frame covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgauge import schemas as S
from rillgauge.functions import clean

EVENT_PARAMETERS = {
    "purchase": S.N_PARAM,
    "view": S.F_PARAM,
    "click": "Phosphorus, total [as P]",
    "signup": "Solids, total suspended / dried",
    "error": "BOD, 5-day, 20 deg. C",
}
FLAG_PARAMETERS = {"A": S.N_PARAM, "R": S.F_PARAM, "N": "Phosphorus, total [as P]"}


# The schemas of the given tables, stated so that no footer is read
# to infer them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _mapped(column: str, names: dict[str, str]) -> Column:
    mapped = F.lit(None).cast("string")
    for key, name in names.items():
        mapped = F.when(F.col(column) == key, F.lit(name)).otherwise(mapped)
    return mapped


def _position(source: str, block: Column, row: Column) -> Column:
    return F.struct(
        F.lit(source).alias("file"), block.cast("bigint").alias("block"), row.cast("bigint").alias("row")
    )


def dmr_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings under one label: below 1 is reported as ``<1``, 300 and above as missing; every third day is of 2023."""
    value = F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("EXTERNAL_PERMIT_NMBR"),
        _mapped("event_type", EVENT_PARAMETERS).alias("PARAMETER_DESC"),
        F.date_format("ts", "MM/dd/yyyy").alias("MONITORING_PERIOD_END_DATE"),
        F.when(F.col("value") < 1, F.lit("<1"))
        .when(F.col("value") < 300, value)
        .alias("DMR_VALUE_STANDARD_UNITS"),
        F.concat(F.lit(" "), value).alias("DMR_VALUE_NMBR"),
        F.when(F.col("value") < 50, F.lit("mg/L")).otherwise(F.lit("ug/L")).alias("DMR_UNIT_DESC"),
        F.when(F.col("value") > 200, F.lit("C")).otherwise(F.lit(" ")).alias("NODI_CODE"),
        F.when(F.dayofmonth("ts") % 3 == 0, F.lit("2023")).otherwise(F.lit("2024")).alias("year"),
        F.lit("2024").alias("label"),
        _position("events", F.expr("event_id div 65536"), F.col("event_id")).alias("source_pos"),
    )


def as_stored(dmr: DataFrame) -> DataFrame:
    """Extract columns computed once, as if they were read from a stored table."""
    names = (
        "label EXTERNAL_PERMIT_NMBR PARAMETER_DESC DMR_UNIT_DESC MONITORING_PERIOD_END_DATE "
        "DMR_VALUE_NMBR NODI_CODE source_pos"
    )
    return dmr.select(clean.once(*[F.col(n) for n in names.split()]))


def permit_of(nation: str, key: str) -> Column:
    """Permit id: two digits of the nation, as a state code, then the key."""
    return F.concat(F.lpad(F.col(nation).cast("string"), 2, "0"), F.lpad(F.col(key).cast("string"), 7, "0"))


def dmr_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of several early years by supplier; high discounts carry a no-data code."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    quantity = F.col("l_quantity").cast("string")
    rows = table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        permit_of("s_nationkey", "l_suppkey").alias("EXTERNAL_PERMIT_NMBR"),
        _mapped("l_returnflag", FLAG_PARAMETERS).alias("PARAMETER_DESC"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("MONITORING_PERIOD_END_DATE"),
        quantity.alias("DMR_VALUE_STANDARD_UNITS"),
        quantity.alias("DMR_VALUE_NMBR"),
        F.when(F.col("l_returnflag") == "R", F.lit("MGD")).otherwise(F.lit("mg/L")).alias("DMR_UNIT_DESC"),
        F.when(F.col("l_discount") >= 0.09, F.lit("9")).alias("NODI_CODE"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("state"),
        F.lit(S.EARLY_LABEL).alias("label"),
        _position(
            "lineitem", F.expr("l_orderkey div 4096"), F.col("l_orderkey") * 8 + F.col("l_linenumber")
        ).alias("source_pos"),
    )


def dmr_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse readings by customer: many permits have no flow row."""
    names = {"1-URGENT": S.N_PARAM, "2-HIGH": S.F_PARAM}
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("EXTERNAL_PERMIT_NMBR"),
        _mapped("o_orderpriority", names).alias("PARAMETER_DESC"),
        F.col("o_totalprice").cast("string").alias("DMR_VALUE_STANDARD_UNITS"),
    )


def facilities_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    customers = table(spark, sf_dir, "customer")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("NPDES_ID"),
        F.col("c_name").alias("FACILITY_NAME"),
        F.col("c_mktsegment").alias("CITY"),
        "state",
    )


def naics_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sectors per permit: the market segment (primary) and the nation, each listed twice."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    both = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    listed = both.select(
        F.col("c_custkey").cast("string").alias("NPDES_ID"),
        F.explode(
            F.array(
                F.struct(F.col("c_mktsegment").alias("NAICS_DESC"), F.lit("Y").alias("PRIMARY_INDICATOR_FLAG")),
                F.struct(F.col("n_name").alias("NAICS_DESC"), F.lit("N").alias("PRIMARY_INDICATOR_FLAG")),
            )
        ).alias("sector"),
    ).select("NPDES_ID", "sector.*")
    return listed.unionByName(listed)


def permits_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two permit versions with different recorded average flows."""
    flow = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("EXTERNAL_PERMIT_NMBR"),
        F.explode(F.array(flow, flow / 2)).alias("ACTUAL_AVERAGE_FLOW_NMBR"),
    )


def _coordinate(i: int) -> Column:
    return F.col("embedding")[i].cast("double")


def raw_facilities(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Facility rows as scanned text, two per vector; the later one is broken for odd labels.

    ``source`` picks the permit ids: users of ``events`` or suppliers of ``lineitem``.
    """
    vectors = table(spark, sf_dir, "embeddings")
    if source == "events":
        owners = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("key"),
            F.col("c_custkey").cast("string").alias("NPDES_ID"),
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATE_CODE"),
        )
    else:
        owners = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("key"),
            permit_of("s_nationkey", "s_suppkey").alias("NPDES_ID"),
            F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("STATE_CODE"),
        )
    later_latitude = F.when(F.col("label") % 2 == 0, _coordinate(2).cast("string")).otherwise(F.lit("n/a"))
    versions = F.array(
        F.struct(
            _coordinate(0).cast("string").alias("GEOCODE_LATITUDE"),
            F.concat(_coordinate(1).cast("string"), F.lit(" ")).alias("GEOCODE_LONGITUDE"),
            F.lit(0).alias("version"),
        ),
        F.struct(
            later_latitude.alias("GEOCODE_LATITUDE"),
            _coordinate(3).cast("string").alias("GEOCODE_LONGITUDE"),
            F.lit(1).alias("version"),
        ),
    )
    return (
        vectors.join(owners, F.col("vec_id") == F.col("key"))
        .select("NPDES_ID", "STATE_CODE", "vec_id", F.explode(versions).alias("v"))
        .select(
            "NPDES_ID",
            "STATE_CODE",
            "v.GEOCODE_LATITUDE",
            "v.GEOCODE_LONGITUDE",
            _position("embeddings", F.lit(0), F.col("vec_id") * 2 + F.col("v.version")).alias("source_pos"),
        )
    )


def located_vectors(spark: SparkSession, sf_dir: str, lat: int, lon: int, id_name: str) -> DataFrame:
    """Two vector dimensions as coordinates."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(id_name), _coordinate(lat).alias("lat"), _coordinate(lon).alias("lon")
    )

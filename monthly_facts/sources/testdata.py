"""Adapter from the shared TPC-H-like test tables to the bronze shape.

Facility = supplier key, procedure = part key, municipality = the supplier's
nation, source file = ``PACE`` + yyMM of the ship date. Money goes through
``decimal(15,2)``, so its text form has the same digits in both engines. The other bronze columns are absent from these tables and are NULL.
The join is left to the planner: it broadcasts supplier only when its
measured size is under the session's threshold and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts import schema as S

# The group and state used for the test source names.
TEST_GROUP = "PA"
TEST_STATE = "CE"
EXTRACT_COLUMNS = [S.FACILITY, S.PROCEDURE, S.MUNICIPALITY, *S.MEASURES, S.SOURCE_COL]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bronze(extracts_from_tables(spark, sf_dir))


def as_bronze(extracts: DataFrame) -> DataFrame:
    """All columns of bronze: those that the extracts lack are NULL."""
    return extracts.select(*[F.col(c) if c in extracts.columns else F.lit(None).cast("string").alias(c) for c in S.COLUMNS_OF_INTEREST],
                           S.SOURCE_COL)


def extracts_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of bronze that the tables have."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_shipdate"
    )
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li["l_suppkey"] == su["s_suppkey"], "inner")
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    qty = F.col("l_quantity").cast("bigint")
    returned = F.col("l_returnflag") == "R"
    mapped = {
        S.FACILITY: F.col("l_suppkey"),
        S.PROCEDURE: F.col("l_partkey"),
        S.MUNICIPALITY: F.col("s_nationkey"),
        "PA_VALPRO": price,
        "PA_VALAPR": F.when(returned, F.lit(0).cast("decimal(15,2)")).otherwise(price),
        "PA_QTDPRO": qty,
        "PA_QTDAPR": F.when(returned, F.lit(0).cast("bigint")).otherwise(qty),
    }
    # Bronze is text: codes keep their digits, measures are read by the rollup.
    cols = [c.cast("string").alias(name) for name, c in mapped.items()]
    source = F.concat(F.lit(TEST_GROUP + TEST_STATE), F.date_format("l_shipdate", "yyMM"))
    return j.select(*cols, source.alias(S.SOURCE_COL))


def facility_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label table for facilities, in the source's column names."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("CNES"), F.col("s_name").alias("FANTASIA"))


def procedure_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label table for procedures, in the source's column names."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("IP_COD"), F.col("p_name").alias("IP_DSCR"))

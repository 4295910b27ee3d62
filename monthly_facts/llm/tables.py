"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts.session import fresh_dir

# Fixed value: the word pattern of the contracts.
WORD = r"[^\x20\x09-\x0D]+"
# Columns that operators add on the way start with this, so that a column of
# the input never clashes with them.
OWN = "__llm_"
HASH_BITS = 60
PAGE_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lineage is
    cut at files that every executor can read, and later plans know their
    size."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: str | Column) -> Column:
    """Words of a whole text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A non-negative 60-bit hash of the document's id (of the text where the
    id is null), the same in any engine that has MD5."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


ROW_HASH_SQL = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15) AS BIGINT)"


def _field(c: str) -> Column:
    return F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-"))


def content_hash(columns: Sequence[str]) -> Column:
    """A non-negative 60-bit hash of all columns of a row, in order of their
    names: what tells rows of one id apart."""
    return F.conv(F.substring(F.md5(F.concat(*[_field(c) for c in sorted(columns)])), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def content_hash_sql(columns: Sequence[str]) -> str:
    fields = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in sorted(columns))
    return f"CAST('0x' || substr(md5({fields}), 1, 15) AS BIGINT)"


def repeated(df: DataFrame, times: str, number: str) -> DataFrame:
    """Each row ``times`` times (0: not at all), numbered from 1. A row that
    comes often is spread over tasks, a page of its repeats each."""
    page, last = OWN + "page", f"least({times}, ({OWN}page + 1) * {PAGE_ROWS})"
    paged = df.where(F.col(times) > 0).withColumn(page, F.expr(f"explode(sequence(0L, ({times} - 1) div {PAGE_ROWS}))"))
    return paged.repartition(page).withColumn(
        number, F.expr(f"explode(sequence({page} * {PAGE_ROWS} + 1, {last}))")).drop(page, times)

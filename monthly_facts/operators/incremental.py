"""Month bookkeeping for incremental ingestion.

Months are DataFrames of ``(ano int, mes int)``. The calendar of months that
should exist comes from ``sequence``/``explode`` over dates, the months
already landed come from the gold table's partition columns, and the months
still to ingest are an anti join of the two. "Today" is always an argument so
runs are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.functions.months import (
    add_months_py,
    month_start,
    source_file_name,
    source_month_date,
)
from monthly_facts.operators.filters import up_to_month

# Months a source month takes to be published, and the first
# month of history ingested when no start is given.
PUBLICATION_LAG_MONTHS = 2
DEFAULT_START = (2018, 1)


def empty_months(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.lit(None).cast("int").alias("ano"), F.lit(None).cast("int").alias("mes"))


def month_range(spark: SparkSession, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Every (ano, mes) from ``first`` to ``last`` inclusive, as one exploded
    ``sequence`` (no join)."""
    lo = _dt.date(first[0], first[1], 1)
    hi = _dt.date(last[0], last[1], 1)
    if lo > hi:
        return empty_months(spark)
    d = F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 MONTH"))).alias("d")
    return spark.range(1).select(d).select(
        F.year("d").cast("int").alias("ano"), F.month("d").cast("int").alias("mes")
    )


def available_months(spark: SparkSession, start: tuple[int, int], today: _dt.date,
                     lag: int = PUBLICATION_LAG_MONTHS) -> DataFrame:
    """Months from ``start`` up to ``today`` minus the publication lag."""
    last = add_months_py(today, -lag)
    return month_range(spark, start, (last.year, last.month))


def landed_months(gold: DataFrame) -> DataFrame:
    """Distinct (ano, mes) present in gold rows. This scans the rows (of a
    partitioned table only the partition columns, but every row of them); the
    months of a stored table come from its folders, ``tables.month_folders``.
    """
    if S.PART_YEAR in gold.columns and S.PART_MONTH in gold.columns:
        cols = [F.col(S.PART_YEAR).cast("int").alias("ano"), F.col(S.PART_MONTH).cast("int").alias("mes")]
    else:
        cols = [F.year(S.DATE_COL).cast("int").alias("ano"), F.month(S.DATE_COL).cast("int").alias("mes")]
    return gold.select(*cols).where(F.col("ano").isNotNull() & F.col("mes").isNotNull()).distinct()


def source_months(bronze: DataFrame) -> DataFrame:
    """Distinct (ano, mes) named by the sources of bronze rows. This scans the
    source-name column; the sources of a stored bronze come from its folders,
    ``bronze.landed_sources``.
    """
    d = source_month_date(S.SOURCE_COL)
    return (
        bronze.select(S.SOURCE_COL).distinct()
        .select(F.year(d).cast("int").alias("ano"), F.month(d).cast("int").alias("mes"))
        .where(F.col("ano").isNotNull())
        .distinct()
    )


def months_frame(spark: SparkSession, months: Iterable[tuple[int, int]]) -> DataFrame:
    """(ano, mes) rows of a calendar-bounded list."""
    return spark.createDataFrame(sorted(set(months)), "ano int, mes int")


def months_of_sources(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Distinct (ano, mes) named by source names; names that do not parse name
    no month."""
    df = spark.createDataFrame([(n,) for n in names], f"{S.SOURCE_COL} string")
    return source_months(df)


def pending_months(available: DataFrame, landed: DataFrame,
                   end: tuple[int, int] | None = None) -> DataFrame:
    """Available months not yet landed, optionally capped at ``end``.

    Starting from a fixed start (not from the latest landed month) means a
    month that failed earlier is retried: gaps heal.
    """
    pending = available.join(landed.select("ano", "mes"), on=["ano", "mes"], how="left_anti")
    return up_to_month(pending, end).orderBy("ano", "mes")


def latest_month(landed: DataFrame) -> DataFrame:
    """One row (ano, mes): the latest landed month in calendar order."""
    m = F.max(F.struct(F.col("ano"), F.col("mes"))).alias("m")
    return landed.agg(m).select(F.col("m.ano").alias("ano"), F.col("m.mes").alias("mes"))


def start_month(landed: DataFrame | None, explicit: tuple[int, int] | None = None,
                after_latest: bool = False, default: tuple[int, int] = DEFAULT_START
                ) -> tuple[int, int]:
    """Where the calendar starts: the explicit start if given; else, with
    ``after_latest``, the month after the latest landed one; else ``default``.

    ``after_latest`` never revisits an earlier gap; the default does.
    """
    if explicit is not None:
        return explicit
    if after_latest and landed is not None:
        row = latest_month(landed).first()
        if row is not None and row["ano"] is not None:
            nxt = add_months_py(_dt.date(row["ano"], row["mes"], 1), 1)
            return (nxt.year, nxt.month)
    return default


def month_dates(months: DataFrame, name: str = "m") -> DataFrame:
    """(ano, mes) rows as first-of-month dates."""
    return months.select(month_start("ano", "mes").alias(name))


def year_month_grid(years: DataFrame, year_col: str = S.YEAR_COL) -> DataFrame:
    """All twelve months of each year in ``years`` (explode, not a join)."""
    return years.select(
        F.col(year_col).cast("int").alias("ano"),
        F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes"),
    )


def source_files(months: DataFrame, group: str, state: str) -> DataFrame:
    """Expected source file name for each (ano, mes), e.g. PACE2401.dbc."""
    return months.select("ano", "mes", source_file_name(group, state, "ano", "mes").alias("arquivo"))

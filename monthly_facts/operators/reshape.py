"""Chart-ready tables: yearly totals, long (tidy) series and pooled means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.functions.labels import series_name, thousands

SERIES_COL = "tipo"
VALUE_COL = "valor"
QUANTITY_COL = "quantidade"


def yearly_totals(monthly: DataFrame, measures: list[str]) -> DataFrame:
    """Sum monthly totals by calendar year of ``data_ref`` (column ``Ano``).

    An all-NULL year sums to 0, as the chart's pandas sum does.
    """
    return (
        monthly.groupBy(F.year(S.DATE_COL).cast("int").alias(S.YEAR_COL))
        .agg(*[F.coalesce(F.sum(m), F.lit(0).cast(monthly.schema[m].dataType)).alias(m)
               for m in measures])
    )


def to_long(df: DataFrame, id_col: str, measures: list[str], value_name: str) -> DataFrame:
    """Wide measures to (id, tipo, value) rows; tipo shows the series name
    (``Produzido`` / ``Aprovado``). NULL cells stay as rows."""
    long = df.unpivot([id_col], measures, SERIES_COL, value_name)
    return long.withColumn(SERIES_COL, series_name(SERIES_COL)).select(id_col, SERIES_COL, value_name)


def yearly_long(monthly: DataFrame, measures: list[str], value_name: str) -> DataFrame:
    """Yearly totals in long form, ordered by series name then year."""
    return to_long(yearly_totals(monthly, measures), S.YEAR_COL, measures, value_name).orderBy(
        SERIES_COL, S.YEAR_COL
    )


def monthly_long(monthly: DataFrame, measures: list[str], value_name: str) -> DataFrame:
    """Monthly totals in long form, ordered for a line chart (date, series)."""
    return to_long(monthly, S.DATE_COL, measures, value_name).orderBy(S.DATE_COL, SERIES_COL)


def value_series(monthly: DataFrame) -> DataFrame:
    return monthly_long(monthly, S.VALUE_MEASURES, VALUE_COL)


def quantity_series(monthly: DataFrame) -> DataFrame:
    return monthly_long(monthly, S.QUANTITY_MEASURES, QUANTITY_COL)


def pooled_mean(long: DataFrame, value_col: str) -> DataFrame:
    """Mean over all rows of a long table, both series pooled (``media``)."""
    return long.agg(F.avg(value_col).alias("media"))


def mean_caption(mean: DataFrame) -> DataFrame:
    """The pooled mean rendered with thousands separators and no decimals."""
    return mean.select(thousands("media", 0).alias("media_fmt"))

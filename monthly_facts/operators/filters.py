"""Optional membership filters.

An absent *or empty* list means "no filter", so the predicate is skipped
instead of becoming ``IN ()`` (which matches nothing in Spark). A list of any
length becomes an ``IN`` predicate that Catalyst pushes into the Parquet scan,
its values cast to the column's type (codes are text, so ``12345`` means the
code ``"12345"`` and never ``"0012345"``). A caller with very many values
passes them as a DataFrame: that becomes a left semi join, which never
duplicates fact rows and lets the planner pick broadcast or sort-merge by the
measured size of that side. An empty DataFrame is a set without members and
keeps nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from monthly_facts import schema as S
from monthly_facts.functions.months import month_key_leq

# English month names in calendar order, used to turn a month
# name filter into a month number filter on the partition column.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def _values(values) -> list | None:
    if values is None or isinstance(values, DataFrame):
        return None
    if isinstance(values, (str, bytes, int)):
        return [values]
    return list(values)


def keep_members(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose ``column`` is in ``values`` (list or one-column DataFrame)."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        dtype = df.schema[column].dataType
        allowed = values.select(F.col(values.columns[0]).cast(dtype).alias(column)).distinct()
        return df.join(allowed, on=column, how="left_semi")
    vals = _values(values)
    if not vals:
        return df
    if isinstance(df.schema[column].dataType, StringType):
        vals = [v if v is None or isinstance(v, str) else str(v) for v in vals]
    return df.where(F.col(column).isin(vals))


def fact_filter(
    df: DataFrame,
    anos: Iterable[int] | None = None,
    meses: Iterable[str] | None = None,
    municipios: Iterable[str] | DataFrame | None = None,
    estabelecimentos: Iterable[str] | DataFrame | None = None,
    procedimentos: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """AND of the present filters over year, month name, municipality,
    facility and procedure; none present keeps every row.

    On a partitioned gold table the year and month filters are also stated on
    the partition columns so that Spark prunes whole directories.
    """
    preds: list[Column] = []
    anos_l = _values(anos)
    if anos_l:
        preds.append(F.col(S.YEAR_COL).isin([int(a) for a in anos_l]))
        if S.PART_YEAR in df.columns:
            preds.append(F.col(S.PART_YEAR).isin([int(a) for a in anos_l]))
    meses_l = _values(meses)
    if meses_l:
        preds.append(F.col(S.MONTH_NAME_COL).isin([str(m) for m in meses_l]))
        if S.PART_MONTH in df.columns:
            nums = [MONTH_NAMES.index(m) + 1 for m in meses_l if m in MONTH_NAMES]
            preds.append(F.col(S.PART_MONTH).isin(nums))
    if preds:
        df = df.where(functools.reduce(lambda a, b: a & b, preds))
    df = keep_members(df, S.MUNICIPALITY, municipios)
    df = keep_members(df, S.FACILITY, estabelecimentos)
    df = keep_members(df, S.PROCEDURE, procedimentos)
    return df


def up_to_month(months: DataFrame, limit: tuple[int, int] | None,
                year_col: str = "ano", month_col: str = "mes") -> DataFrame:
    """Drop (year, month) rows after ``limit``; ``None`` keeps all."""
    if limit is None:
        return months
    return months.where(month_key_leq(year_col, month_col, limit))

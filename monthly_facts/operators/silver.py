"""Silver: bronze rows with the columns of interest plus month, year, state.

``arquivo_origem`` (the source file's name) must already be a column: a landed
bronze table carries it as its partition column, a foreign tree gets it from
``sources.bronze.read_bronze_tree``. The month is parsed from that name; rows
whose name does not parse are dropped, as the source's coerce-and-drop does.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.functions.months import (
    month_name,
    source_month_date,
    source_state,
    year_of,
)
from monthly_facts.operators.filters import keep_members


DERIVED = [S.SOURCE_COL, S.DATE_COL, S.YEAR_COL, S.MONTH_NAME_COL, S.STATE_COL]


def derive_silver(
    bronze: DataFrame,
    facilities: Iterable[str] | DataFrame | None = None,
    columns: list[str] | None = S.COLUMNS_OF_INTEREST,
) -> DataFrame:
    """Bronze -> silver: ``columns`` as text, then the five derived columns.

    With the default columns the result is ``schema.SILVER_SCHEMA`` (31
    columns); ``columns=None`` keeps every bronze column as it is.
    ``facilities`` optionally restricts the facility code (``PA_CODUNI``); a
    Python list becomes an ``IN`` predicate pushed to the scan, a DataFrame of
    codes a semi join. ``None`` or an empty list keeps every row.
    """
    df = S.drop_duplicate_columns(bronze)
    if S.SOURCE_COL not in df.columns:
        raise ValueError(f"bronze needs a {S.SOURCE_COL!r} column with the source file name")
    df = keep_members(df, S.FACILITY, facilities)
    if columns is None:
        kept = [F.col(c) for c in df.columns if c not in DERIVED]
    else:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"bronze lacks columns {missing}")
        kept = [F.col(c).cast("string").alias(c) for c in columns]
    d = source_month_date(S.SOURCE_COL)
    return (
        df.select(*kept, F.col(S.SOURCE_COL).cast("string").alias(S.SOURCE_COL), d.alias(S.DATE_COL))
        .where(F.col(S.DATE_COL).isNotNull())
        .withColumn(S.YEAR_COL, year_of(S.DATE_COL))
        .withColumn(S.MONTH_NAME_COL, month_name(S.DATE_COL))
        .withColumn(S.STATE_COL, source_state(S.SOURCE_COL))
    )


def silver_for_months(silver: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Keep only the given (year, month) pairs, as a date ``IN`` list.

    On a bronze landed by source name the predicate only references the
    partition column, so Spark prunes whole source directories.
    """
    if not months:
        return silver.where("false")
    dates = ", ".join(f"DATE'{_dt.date(a, m, 1).isoformat()}'" for a, m in months)
    return silver.where(F.expr(f"{S.DATE_COL} IN ({dates})"))

"""Read-side queries over gold or the consolidated table.

These are the questions the dashboard asks: which years, months and
municipalities exist, and filtered totals per month. Every function takes and
returns a DataFrame; callers decide when to act on it. ``to_records`` and
``to_list`` are the only collects, meant for the small final answers (one row
per month or per option), never for fact rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.operators.filters import fact_filter


def monthly_sums(
    facts: DataFrame,
    anos: Iterable[int] | None = None,
    meses: Iterable[str] | None = None,
    municipios: Iterable[str] | DataFrame | None = None,
    estabelecimentos: Iterable[str] | DataFrame | None = None,
    procedimentos: Iterable[str] | DataFrame | None = None,
    measures: list[str] | None = None,
) -> DataFrame:
    """Filtered sums per ``data_ref``, in no order (for further aggregation).

    The result has one row per month whatever the data size; Spark computes it
    with a partial aggregate per task and a small final merge.
    """
    measures = measures or S.MEASURES
    df = fact_filter(facts, anos, meses, municipios, estabelecimentos, procedimentos)
    return df.groupBy(S.DATE_COL).agg(*[F.sum(m).alias(m) for m in measures])


def monthly_totals(facts: DataFrame, *args, **kwargs) -> DataFrame:
    """``monthly_sums`` ordered by date."""
    return monthly_sums(facts, *args, **kwargs).orderBy(S.DATE_COL)


def years(facts: DataFrame) -> DataFrame:
    """Distinct years, ascending."""
    return facts.select(S.YEAR_COL).distinct().orderBy(F.col(S.YEAR_COL).asc_nulls_last())


def month_firsts(facts: DataFrame, anos: Iterable[int]) -> DataFrame:
    """(Mes, first_date) for the chosen years, ordered by first_date.

    At least one year is required, as the source's endpoint requires it.
    """
    anos_l = [int(a) for a in anos] if anos is not None else []
    if not anos_l:
        raise ValueError("months_of_years needs at least one year")
    df = fact_filter(facts, anos=anos_l)
    return (
        df.groupBy(S.MONTH_NAME_COL)
        .agg(F.min(S.DATE_COL).alias("first_date"))
        .orderBy(F.col("first_date").asc_nulls_last())
    )


def months_of_years(facts: DataFrame, anos: Iterable[int]) -> DataFrame:
    """Month names present in the chosen years, ordered by their first date
    (chronological over the chosen years, not calendar order)."""
    return month_firsts(facts, anos).select(S.MONTH_NAME_COL)


def municipalities(facts: DataFrame) -> DataFrame:
    """Distinct municipality codes, ascending with NULL last."""
    return facts.select(S.MUNICIPALITY).distinct().orderBy(F.col(S.MUNICIPALITY).asc_nulls_last())


def year_bounds(facts: DataFrame) -> DataFrame:
    """One row: smallest and largest year (``lo``, ``hi``)."""
    return facts.agg(F.min(S.YEAR_COL).alias("lo"), F.max(S.YEAR_COL).alias("hi"))


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns) of a result; counts on the cluster."""
    return df.count(), len(df.columns)


def preview(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of an already ordered result."""
    return df.limit(n)


# A final answer has a row per month or per option.
MAX_ANSWER_ROWS = 100_000


def _answer(df: DataFrame, max_rows: int) -> list:
    """All rows of a final answer; more than ``max_rows`` is an error, nothing
    is left out."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"the result has more than {max_rows} rows; write it instead (write_records)")
    return rows


def to_records(df: DataFrame, max_rows: int = MAX_ANSWER_ROWS) -> list[dict]:
    """Rows as JSON-ready dicts; for final answers of at most ``max_rows``."""
    return [r.asDict() for r in _answer(df, max_rows)]


def to_list(df: DataFrame, column: str | None = None, max_rows: int = MAX_ANSWER_ROWS) -> list:
    """One column as a Python list; for final answers of at most ``max_rows``."""
    column = column or df.columns[0]
    return [r[0] for r in _answer(df.select(column), max_rows)]


def write_records(df: DataFrame, path: str) -> None:
    """Write a result as JSON lines (one record per row), ISO dates."""
    df.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(path)


def read_records(spark, path: str, schema: str | None = None) -> DataFrame:
    """Read JSON records back. With a DDL ``schema`` (default: monthly
    totals) ISO date strings are parsed as dates, not left as text."""
    schema = schema or ("data_ref date, PA_VALPRO double, PA_VALAPR double, "
                        "PA_QTDPRO bigint, PA_QTDAPR bigint")
    return spark.read.schema(schema).option("dateFormat", "yyyy-MM-dd").json(path)


def collect_tables(tables: dict[str, DataFrame], first: str | None = "monthly",
                   max_parallel: int = 4, max_rows: int = MAX_ANSWER_ROWS) -> dict[str, list]:
    """Collect several final answers of at most ``max_rows`` each, e.g. the
    dashboard's tables.

    ``first`` is collected alone (it fills the cache the others read), the
    rest are submitted from threads so Spark runs their jobs side by side.
    """
    from concurrent.futures import ThreadPoolExecutor

    out: dict[str, list] = {}
    if first is not None and first in tables:
        out[first] = _answer(tables[first], max_rows)
    rest = {k: v for k, v in tables.items() if k not in out}
    if rest:
        with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(rest)))) as pool:
            futures = {k: pool.submit(_answer, df, max_rows) for k, df in rest.items()}
            for k, fut in futures.items():
                out[k] = fut.result()
    return out

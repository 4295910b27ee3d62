"""Gold: the monthly rollup by facility, month, municipality and procedure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.functions.months import month_name, year_of


def parsed(measure: str, round_fractions: bool = False) -> Column:
    """A measure's text as double (values) or bigint (quantities), NULL where
    it does not parse. With ``round_fractions`` a fractional quantity is
    rounded half away from zero first (``'12.5'`` -> 13), as a SQL engine's
    text-to-bigint cast may do; else it does not parse."""
    c = F.col(measure)
    if measure in S.VALUE_MEASURES:
        return c.try_cast("double")
    if round_fractions:
        return F.round(c.try_cast("decimal(38,6)"), 0).try_cast("bigint")
    return c.try_cast("bigint")


def unparsed(measure: str, round_fractions: bool = False) -> Column:
    """Whether a measure has a text that does not parse."""
    return F.col(measure).isNotNull() & parsed(measure, round_fractions).isNull()


BAD_ROWS = "bad_rows"
_KEYS = [S.FACILITY, S.DATE_COL, S.MUNICIPALITY, S.PROCEDURE]


def _text(measure: str) -> str:
    return measure + "_text"


def _measures(silver: DataFrame, round_quantities: bool) -> DataFrame:
    """Keys, parsed measures and their texts: each text is parsed once."""
    return silver.select(*_KEYS, *[parsed(m, round_quantities).alias(m) for m in S.MEASURES],
                         *[F.col(m).alias(_text(m)) for m in S.MEASURES])


def _bad(measure: str) -> Column:
    return F.col(_text(measure)).isNotNull() & F.col(measure).isNull()


def with_month_names(sums: DataFrame, *more: str) -> DataFrame:
    """The gold columns of sums by the four keys."""
    return (
        sums.withColumn(S.YEAR_COL, year_of(S.DATE_COL))
        .withColumn(S.MONTH_NAME_COL, month_name(S.DATE_COL))
        .select(*S.GOLD_COLUMNS, *more)
    )


def sums(silver: DataFrame, round_quantities: bool = False) -> DataFrame:
    """Sum the four measures per (facility, Ano, Mes, data_ref, municipality,
    procedure).

    Values are read as double and quantities as bigint: a non-numeric measure
    fails the job, whatever the session's ANSI setting. SQL
    sum semantics: NULLs are ignored, an all-NULL group sums to NULL, and a
    NULL key forms its own group.

    All four aggregates are sums, so Spark aggregates partially before the
    shuffle: a hot key (one facility holding a third of the rows) ships one
    partial row per map task, not its raw rows.

    ``Ano`` and ``Mes`` are functions of ``data_ref`` in silver, so the hash
    key is the four independent keys and the two are derived once per output
    row (``rollup``, or behind the shuffle of a write): same groups, a narrower
    shuffle and no month-name formatting per input row.
    """
    def strict(m: str) -> Column:
        message = F.concat(F.lit(f"{m} is not a number: "), F.col(_text(m)))
        return F.when(_bad(m), F.raise_error(message)).otherwise(F.col(m))

    return _measures(silver, round_quantities).groupBy(*_KEYS).agg(*[F.sum(strict(m)).alias(m) for m in S.MEASURES])


def rollup(silver: DataFrame, round_quantities: bool = False) -> DataFrame:
    """``sums`` with the year and the month's name: the gold columns."""
    return with_month_names(sums(silver, round_quantities))


def counted_sums(silver: DataFrame, round_quantities: bool = False) -> DataFrame:
    """``sums`` that does not fail: texts that are no numbers are left out of
    the sums, and ``bad_rows`` counts the rows of a group that have any."""
    bad = _bad(S.MEASURES[0])
    for m in S.MEASURES[1:]:
        bad = bad | _bad(m)
    return _measures(silver, round_quantities).groupBy(*_KEYS).agg(
        *[F.sum(m).alias(m) for m in S.MEASURES], F.count_if(bad).alias(BAD_ROWS))


def with_month_partition(gold: DataFrame) -> DataFrame:
    """Add the integer partition columns ``ref_ano`` / ``ref_mes`` from data_ref."""
    return gold.withColumn(S.PART_YEAR, F.year(S.DATE_COL).cast("int")).withColumn(
        S.PART_MONTH, F.month(S.DATE_COL).cast("int")
    )

"""Column expressions about months: source names, dates, month keys.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing runs row by row in Python.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source file names are <group:2 letters><state:2 letters><yy><mm>,
# optionally followed by a split-file suffix (e.g. PACE2401, PACE2401a).
SOURCE_NAME_PATTERN = r"^([A-Za-z]{2})([A-Za-z]{2})(\d{2})(\d{2})"
# The same with a month that exists.
SOURCE_MONTH_PATTERN = r"^[A-Za-z]{4}\d{2}(?:0[1-9]|1[0-2])"
# The century is fixed to 20 for the two-digit year in the name.
CENTURY_PREFIX = "20"
# Months are rendered by their English name, e.g. January.
MONTH_NAME_FORMAT = "MMMM"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def source_group(name: str | Column) -> Column:
    return F.regexp_extract(_col(name), SOURCE_NAME_PATTERN, 1)


def source_state(name: str | Column) -> Column:
    """State code: letters 3-4 of a well-formed source name."""
    return F.regexp_extract(_col(name), SOURCE_NAME_PATTERN, 2)


def source_month_date(name: str | Column) -> Column:
    """First day of the month named by a source file, NULL when unparseable.

    Tolerant like a coerce-on-error parse: a name without the pattern, or a
    month outside 01-12, yields NULL instead of failing the job.
    """
    c = _col(name)
    # One match per row; behind it the digits are at fixed places.
    year = F.concat(F.lit(CENTURY_PREFIX), F.substring(c, 5, 2)).try_cast("int")
    return F.when(c.rlike(SOURCE_MONTH_PATTERN), F.make_date(year, F.substring(c, 7, 2).try_cast("int"), F.lit(1)))


def year_of(d: str | Column) -> Column:
    return F.year(_col(d)).cast("int")


def month_name(d: str | Column) -> Column:
    """English month name (``January``), not the three-letter form."""
    return F.date_format(_col(d), MONTH_NAME_FORMAT)


def source_file_name(group: str, state: str, year: str | Column, month: str | Column,
                     extension: str = ".dbc") -> Column:
    """Expected source file name, e.g. ``PACE2401.dbc`` for 2024-01."""
    return F.format_string(
        f"%s%s%02d%02d{extension}", F.lit(group), F.lit(state),
        F.pmod(_col(year), F.lit(100)), _col(month),
    )


def month_start(year: str | Column, month: str | Column) -> Column:
    """Date of the first day of (year, month); NULL for an invalid pair."""
    text = F.format_string("%04d-%02d", _col(year), _col(month))
    return F.try_to_date(text, "yyyy-MM")


def partition_value(path: str | Column, key: str) -> Column:
    """Integer value of ``key=<digits>`` inside a path, NULL when absent.

    The first folder of that name is cut out as text; the whole path is
    searched only where its value is not all digits."""
    c = _col(path)
    name = f"/{key}="
    first = F.substring_index(F.substring_index(F.substring_index(F.concat(F.lit("/"), c), name, 2), name, -1), "/", 1)
    digits = (first != "") & (F.translate(first, "0123456789", "") == "")
    found = F.regexp_extract(c, rf"(?:^|/){key}=(\d+)(?:/|$)", 1)
    return F.when(digits, first.cast("int")).when(c.contains(f"{key}=") & (found != ""), found.cast("int"))


def month_key_leq(year: str | Column, month: str | Column, limit: tuple[int, int]) -> Column:
    """(year, month) <= limit in calendar order."""
    return F.struct(_col(year).alias("a"), _col(month).alias("m")) <= F.struct(
        F.lit(limit[0]).alias("a"), F.lit(limit[1]).alias("m")
    )


def add_months_py(d: _dt.date, n: int) -> _dt.date:
    """First of the month ``n`` months after ``d``'s month (driver-side scalar)."""
    idx = d.year * 12 + (d.month - 1) + n
    return _dt.date(idx // 12, idx % 12 + 1, 1)

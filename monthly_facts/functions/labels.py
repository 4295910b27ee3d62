"""Column expressions for display labels and chart series names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator between code and name in a dimension label.
LABEL_SEPARATOR = " - "

# Display names of the measure series in long tables.
SERIES_NAMES = {
    "PA_VALPRO": "Produzido",
    "PA_VALAPR": "Aprovado",
    "PA_QTDPRO": "Produzido",
    "PA_QTDAPR": "Aprovado",
}


def code_label(code: str | Column, name: str | Column) -> Column:
    """``code - name``; NULL when either part is NULL (``concat`` semantics)."""
    c = F.col(code) if isinstance(code, str) else code
    n = F.col(name) if isinstance(name, str) else name
    return F.concat(c, F.lit(LABEL_SEPARATOR), n)


def series_name(measure: str | Column) -> Column:
    """Map a measure column name to its series display name; others unchanged."""
    m = F.col(measure) if isinstance(measure, str) else measure
    expr = None
    for src, dst in SERIES_NAMES.items():
        expr = (F.when(m == src, F.lit(dst)) if expr is None
                else expr.when(m == src, F.lit(dst)))
    return expr.otherwise(m)


def thousands(x: str | Column, decimals: int = 0) -> Column:
    """Number with comma thousands separators, e.g. 1,234,568."""
    c = F.col(x) if isinstance(x, str) else x
    return F.format_number(c, decimals)

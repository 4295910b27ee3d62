"""Scalar column expressions (all built-in Spark functions)."""

from monthly_facts.functions.labels import code_label, series_name, thousands
from monthly_facts.functions.months import (
    month_key_leq,
    month_name,
    month_start,
    partition_value,
    source_file_name,
    source_group,
    source_month_date,
    source_state,
    year_of,
)

__all__ = [
    "code_label", "series_name", "thousands",
    "month_key_leq", "month_name", "month_start", "partition_value",
    "source_file_name", "source_group", "source_month_date", "source_state", "year_of",
]

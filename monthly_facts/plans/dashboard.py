"""The tables behind the dashboard, as one composed plan.

Chosen labels become semi joins against the dimensions, the remaining
filters become pushed-down predicates, and everything after the monthly
totals works on one row per month.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from monthly_facts import schema as S
from monthly_facts.operators import dims as D
from monthly_facts.operators import reshape as R
from monthly_facts.operators.dims import filter_by_labels
from monthly_facts.operators.serve import monthly_sums


def dashboard_tables(
    facts: DataFrame,
    facility_dim: DataFrame | None = None,
    procedure_dim: DataFrame | None = None,
    anos: Iterable[int] | None = None,
    meses: Iterable[str] | None = None,
    municipios: Iterable[str] | None = None,
    facility_labels: Iterable[str] | None = None,
    procedure_labels: Iterable[str] | None = None,
    persist: bool = False,
) -> dict[str, DataFrame]:
    """Monthly totals for the current filters and every chart table
    derived from them.

    The derived tables are computed from the unordered sums; only ``monthly``
    itself is ordered. With ``persist`` the sums (one row per month) are kept
    in executor memory after their first use, so the six derived tables do
    not each rescan the facts; the caller then unpersists
    ``tables["monthly_sums"]``. A lost executor only means the cached rows are
    recomputed from the plan.
    """
    if procedure_dim is not None:
        facts = filter_by_labels(facts, procedure_dim, S.PROCEDURE, D.PROCEDURE_LABEL, procedure_labels)
    if facility_dim is not None:
        facts = filter_by_labels(facts, facility_dim, S.FACILITY, D.FACILITY_LABEL, facility_labels)
    monthly = monthly_sums(facts, anos=anos, meses=meses, municipios=municipios)
    if persist:
        monthly = monthly.persist(StorageLevel.MEMORY_AND_DISK)
    value_series = R.value_series(monthly)
    quantity_series = R.quantity_series(monthly)
    return {
        "monthly_sums": monthly,
        "monthly": monthly.orderBy(S.DATE_COL),
        "yearly_values": R.yearly_long(monthly, S.VALUE_MEASURES, R.VALUE_COL),
        "yearly_quantities": R.yearly_long(monthly, S.QUANTITY_MEASURES, R.QUANTITY_COL),
        "value_series": value_series,
        "quantity_series": quantity_series,
        "value_mean": R.pooled_mean(value_series, R.VALUE_COL),
        "quantity_mean": R.pooled_mean(quantity_series, R.QUANTITY_COL),
    }

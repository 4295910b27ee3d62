"""Labelled dimensions and label-to-code lookups.

A dimension is the distinct (code, name) pairs of a label table plus a
``code - name`` label. It is distinct on the pair, not on the code, so a code
with two names has two rows; lookups therefore use semi joins, which keep each
fact row at most once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.functions.labels import code_label
from monthly_facts.operators.filters import keep_members

# Label-table column names and the dimension columns they become.
FACILITY_SOURCE_CODE = "CNES"
FACILITY_NAME = "FANTASIA"
FACILITY_LABEL = "label_estabelecimento"
PROCEDURE_SOURCE_CODE = "IP_COD"
PROCEDURE_NAME = "IP_DSCR"
PROCEDURE_LABEL = "label_procedimento"


def build_dimension(labels: DataFrame, source_code: str, key: str, name: str,
                    label: str) -> DataFrame:
    """Rename the code column to ``key``, keep (key, name) as text, dedupe the
    pairs and add ``label = key || ' - ' || name`` (NULL if the name is NULL)."""
    df = labels.withColumnRenamed(source_code, key) if source_code != key else labels
    return (
        df.select(F.col(key).cast("string").alias(key), F.col(name).cast("string").alias(name))
        .dropDuplicates([key, name])
        .withColumn(label, code_label(key, name))
    )


def facility_dimension(labels: DataFrame, source_code: str = FACILITY_SOURCE_CODE,
                       name: str = FACILITY_NAME) -> DataFrame:
    """``PA_CODUNI, FANTASIA, label_estabelecimento``."""
    dim = build_dimension(labels, source_code, S.FACILITY, name, FACILITY_LABEL)
    return dim.withColumnRenamed(name, FACILITY_NAME) if name != FACILITY_NAME else dim


def procedure_dimension(labels: DataFrame, source_code: str = PROCEDURE_SOURCE_CODE,
                        name: str = PROCEDURE_NAME) -> DataFrame:
    """``PA_PROC_ID, IP_DSCR, label_procedimento``."""
    dim = build_dimension(labels, source_code, S.PROCEDURE, name, PROCEDURE_LABEL)
    return dim.withColumnRenamed(name, PROCEDURE_NAME) if name != PROCEDURE_NAME else dim


def label_options(dim: DataFrame, label: str) -> DataFrame:
    """The label column sorted ascending (NULL last), one row per dimension row."""
    return dim.select(label).orderBy(F.col(label).asc_nulls_last())


def codes_for_labels(dim: DataFrame, key: str, label: str,
                     labels: Iterable[str] | DataFrame) -> DataFrame:
    """Distinct codes whose label is among ``labels``."""
    return keep_members(dim, label, labels).select(key).distinct()


def filter_by_labels(facts: DataFrame, dim: DataFrame, key: str, label: str,
                     labels: Iterable[str] | DataFrame | None) -> DataFrame:
    """Facts whose code carries one of the chosen labels; no labels, no filter.

    Implemented as a left semi join against the matching codes, so facts are
    never duplicated even if a code has several labels.
    """
    if labels is None:
        return facts
    if not isinstance(labels, DataFrame):
        labels = list(labels)
        if not labels:
            return facts
    return facts.join(codes_for_labels(dim, key, label, labels), on=key, how="left_semi")

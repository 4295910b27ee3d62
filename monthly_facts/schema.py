"""Column lists and explicit schemas for every layer.

Bronze and silver keep the source's text columns as ``string`` so codes keep
their leading zeros and the rollup decides how to read measures. Schemas are
declared here once instead of being inferred from whichever file is read
first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source columns kept in silver, in the source's order.
COLUMNS_OF_INTEREST = [
    "PA_MUNPCN", "PA_PROC_ID", "PA_TPFIN", "PA_NIVCPL", "PA_CIDPRI",
    "PA_SUBFIN", "PA_DOCORIG", "PA_UFDIF", "PA_MNDIF", "PA_INDICA",
    "PA_MVM", "PA_CMP", "PA_SEXO", "PA_IDADE", "PA_OBITO", "PA_ENCERR",
    "PA_PERMAN", "PA_ALTA", "PA_TRANSF", "PA_CODUNI", "PA_AUTORIZ",
    "PA_CBOCOD", "PA_QTDPRO", "PA_QTDAPR", "PA_VALPRO", "PA_VALAPR",
]

SOURCE_COL = "arquivo_origem"
DATE_COL = "data_ref"
YEAR_COL = "Ano"
MONTH_NAME_COL = "Mes"
STATE_COL = "UF"

FACILITY = "PA_CODUNI"
MUNICIPALITY = "PA_MUNPCN"
PROCEDURE = "PA_PROC_ID"

VALUE_MEASURES = ["PA_VALPRO", "PA_VALAPR"]
QUANTITY_MEASURES = ["PA_QTDPRO", "PA_QTDAPR"]
MEASURES = VALUE_MEASURES + QUANTITY_MEASURES

# Grouping keys of the monthly rollup, in output order.
GOLD_KEYS = [FACILITY, YEAR_COL, MONTH_NAME_COL, DATE_COL, MUNICIPALITY, PROCEDURE]
GOLD_COLUMNS = GOLD_KEYS + MEASURES

# Partition columns of the published gold table. They are deliberately not
# called ano/mes: Spark resolves names case-insensitively, so a path column
# ``mes`` would shadow the month-name column ``Mes``.
PART_YEAR = "ref_ano"
PART_MONTH = "ref_mes"

BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in COLUMNS_OF_INTEREST]
)

SILVER_SCHEMA = T.StructType(
    list(BRONZE_SCHEMA.fields)
    + [
        T.StructField(SOURCE_COL, T.StringType(), True),
        T.StructField(DATE_COL, T.DateType(), False),
        T.StructField(YEAR_COL, T.IntegerType(), True),
        T.StructField(MONTH_NAME_COL, T.StringType(), True),
        T.StructField(STATE_COL, T.StringType(), True),
    ]
)

GOLD_SCHEMA = T.StructType(
    [
        T.StructField(FACILITY, T.StringType(), True),
        T.StructField(YEAR_COL, T.IntegerType(), True),
        T.StructField(MONTH_NAME_COL, T.StringType(), True),
        T.StructField(DATE_COL, T.DateType(), True),
        T.StructField(MUNICIPALITY, T.StringType(), True),
        T.StructField(PROCEDURE, T.StringType(), True),
        T.StructField("PA_VALPRO", T.DoubleType(), True),
        T.StructField("PA_VALAPR", T.DoubleType(), True),
        T.StructField("PA_QTDPRO", T.LongType(), True),
        T.StructField("PA_QTDAPR", T.LongType(), True),
    ]
)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, same order, each column cast.

    A missing column is an error, as it is for a scan asked for columns the
    files do not have. Casts follow the session's ANSI setting, so a value
    that does not fit fails the job instead of turning into NULL.
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"input lacks columns {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several same-named columns (names compared exactly).

    Columns are renamed by position first, because a duplicated name cannot
    be selected by name.
    """
    names = df.columns
    if len(set(names)) == len(names):
        return df
    tagged = [f"{n}__pos{i}" for i, n in enumerate(names)]
    seen: set[str] = set()
    keep = []
    for tag, name in zip(tagged, names):
        if name not in seen:
            seen.add(name)
            keep.append(F.col(f"`{tag}`").alias(name))
    return df.toDF(*tagged).select(keep)

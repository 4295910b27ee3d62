import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import monthly_facts as mf
from monthly_facts import schema as S
from tests.conftest import bronze_rows


def _rows(spark):
    return bronze_rows(spark, [
        {"PA_CODUNI": "0012345", "PA_MUNPCN": "230440", "PA_PROC_ID": "p1", "PA_VALPRO": "10.50",
         "PA_VALAPR": "10.00", "PA_QTDPRO": "2", "PA_QTDAPR": "1", "arquivo_origem": "PACE2401"},
        {"PA_CODUNI": "0012345", "PA_MUNPCN": "230440", "PA_PROC_ID": "p1", "PA_VALPRO": None,
         "PA_VALAPR": "1.00", "PA_QTDPRO": "3", "PA_QTDAPR": None, "arquivo_origem": "PACE2401a"},
        {"PA_CODUNI": "9", "PA_MUNPCN": None, "PA_PROC_ID": "p2", "PA_VALPRO": None,
         "PA_VALAPR": None, "PA_QTDPRO": "1", "PA_QTDAPR": "1", "arquivo_origem": "PACE2402"},
        {"PA_CODUNI": "9", "PA_MUNPCN": "1", "PA_PROC_ID": "p2", "PA_VALPRO": "5",
         "PA_VALAPR": "5", "PA_QTDPRO": "1", "PA_QTDAPR": "1", "arquivo_origem": "PACE2413"},
        {"PA_CODUNI": "9", "PA_MUNPCN": "1", "PA_PROC_ID": "p2", "PA_VALPRO": "5",
         "PA_VALAPR": "5", "PA_QTDPRO": "1", "PA_QTDAPR": "1", "arquivo_origem": "PACEXXYY"},
    ])


def test_silver_schema_and_drops(spark):
    s = mf.derive_silver(_rows(spark))
    assert s.columns == [f.name for f in S.SILVER_SCHEMA.fields]
    rows = s.collect()
    assert len(rows) == 3  # bad month and no-digit names dropped
    r = [x for x in rows if x.arquivo_origem == "PACE2401"][0]
    assert (r.data_ref, r.Ano, r.Mes, r.UF, r.PA_CODUNI) == (dt.date(2024, 1, 1), 2024, "January", "CE", "0012345")


def test_silver_facility_filter(spark):
    b = _rows(spark)
    assert mf.derive_silver(b, facilities=[]).count() == 3        # empty list: no filter
    assert mf.derive_silver(b, facilities=["0012345"]).count() == 2
    codes = spark.createDataFrame([("9",), ("9",)], "c string")
    assert mf.derive_silver(b, facilities=codes).count() == 1      # semi join, no duplicates


def test_silver_duplicate_columns_keep_first(spark):
    b = _rows(spark)
    dup = b.select(*b.columns, F.lit("zzz").alias("PA_CODUNI"))
    s = mf.derive_silver(dup)
    assert "zzz" not in {r.PA_CODUNI for r in s.collect()}


def test_silver_missing_column_fails(spark):
    with pytest.raises(ValueError):
        mf.derive_silver(_rows(spark).drop("PA_SEXO"))


def test_gold_sums_and_nulls(spark):
    g = mf.rollup(mf.derive_silver(_rows(spark)))
    assert g.columns == S.GOLD_COLUMNS
    assert [f.dataType.simpleString() for f in g.schema.fields][-4:] == ["double", "double", "bigint", "bigint"]
    rows = {(r.PA_CODUNI, r.data_ref): r for r in g.collect()}
    jan = rows[("0012345", dt.date(2024, 1, 1))]
    assert jan.PA_VALPRO == pytest.approx(10.50)   # null ignored
    assert jan.PA_QTDPRO == 5 and jan.PA_QTDAPR == 1
    feb = rows[("9", dt.date(2024, 2, 1))]
    assert feb.PA_VALPRO is None                   # all null -> null
    assert feb.PA_MUNPCN is None                   # null key is its own group


def test_gold_bad_measure_fails(spark):
    b = bronze_rows(spark, [{"PA_CODUNI": "1", "PA_VALPRO": "x", "arquivo_origem": "PACE2401"}])
    with pytest.raises(PySparkException):
        mf.rollup(mf.derive_silver(b)).collect()


def test_align(spark):
    df = spark.createDataFrame([("1", "2")], "PA_QTDPRO string, extra string")
    from pyspark.sql import types as T
    out = S.align(df, T.StructType([T.StructField("PA_QTDPRO", T.LongType())]))
    assert out.collect()[0][0] == 1 and out.columns == ["PA_QTDPRO"]
    with pytest.raises(ValueError):
        S.align(df, T.StructType([T.StructField("nope", T.LongType())]))


def test_fractional_quantity_strict_or_rounded(spark):
    b = bronze_rows(spark, [{"PA_CODUNI": "1", "PA_QTDPRO": "12.5", "PA_QTDAPR": "-2.5", "arquivo_origem": "PACE2401"}])
    with pytest.raises(PySparkException):
        mf.rollup(mf.derive_silver(b)).collect()
    r = mf.rollup(mf.derive_silver(b), round_quantities=True).first()
    assert (r.PA_QTDPRO, r.PA_QTDAPR) == (13, -3)


def test_silver_column_choice(spark):
    b = _rows(spark).withColumn("EXTRA", F.lit(7))
    assert mf.derive_silver(b).columns == [f.name for f in S.SILVER_SCHEMA.fields]
    everything = mf.derive_silver(b, columns=None)
    assert "EXTRA" in everything.columns and dict(everything.dtypes)["EXTRA"] == "int"
    few = mf.derive_silver(b, columns=["PA_CODUNI", "PA_VALPRO"])
    assert few.columns == ["PA_CODUNI", "PA_VALPRO", "arquivo_origem", "data_ref", "Ano", "Mes", "UF"]

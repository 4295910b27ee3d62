import datetime as dt

from pyspark.sql import functions as F

from monthly_facts.functions import (
    code_label, month_name, month_start, partition_value, series_name, source_file_name,
    source_month_date, source_state, thousands,
)


def test_source_name_parsing(spark):
    df = spark.createDataFrame(
        [("PACE2401",), ("PACE2413",), ("PACEXXYY",), ("PACE2401a",), ("PASP1812",), (None,),
         ("pace2402",), ("202401",)], "n string")
    rows = df.select("n", source_month_date("n").alias("d"), source_state("n").alias("uf")).collect()
    got = {r.n: (r.d, r.uf) for r in rows}
    assert got["PACE2401"] == (dt.date(2024, 1, 1), "CE")
    assert got["PACE2413"][0] is None          # bad month
    assert got["PACEXXYY"][0] is None          # no digits
    assert got["PACE2401a"][0] == dt.date(2024, 1, 1)  # split-file suffix
    assert got["PASP1812"] == (dt.date(2018, 12, 1), "SP")
    assert got[None][0] is None
    assert got["pace2402"] == (dt.date(2024, 2, 1), "ce")  # letters of either case
    assert got["202401"][0] is None                        # a bare yyyymm folder is not a source name


def test_month_name_is_english_full_name(spark):
    r = spark.range(1).select(month_name(F.lit(dt.date(2024, 3, 1))).alias("m")).first()
    assert r.m == "March"


def test_label_null_propagates(spark):
    df = spark.createDataFrame([("1", "A"), ("2", None)], "c string, n string")
    got = {r.c: r.l for r in df.select("c", code_label("c", "n").alias("l")).collect()}
    assert got == {"1": "1 - A", "2": None}


def test_series_name_and_thousands(spark):
    df = spark.createDataFrame([("PA_VALPRO", 1234567.5), ("PA_QTDAPR", 1.0), ("x", 0.4)], "t string, v double")
    rows = df.select(series_name("t").alias("s"), thousands("v").alias("f")).collect()
    assert [r.s for r in rows] == ["Produzido", "Aprovado", "x"]
    assert rows[0].f == "1,234,568"


def test_source_file_name_and_month_start(spark):
    df = spark.createDataFrame([(2024, 1), (2009, 12), (2024, 13)], "a int, m int")
    rows = df.select(source_file_name("PA", "CE", "a", "m").alias("f"), month_start("a", "m").alias("d")).collect()
    assert [r.f for r in rows[:2]] == ["PACE2401.dbc", "PACE0912.dbc"]
    assert rows[0].d == dt.date(2024, 1, 1) and rows[2].d is None


def test_partition_value(spark):
    df = spark.createDataFrame([("s3a://b/gold/ano=2024/mes=03/dados.parquet",), ("/x/ano=abc/mes=1/f",)], "p string")
    rows = df.select(partition_value("p", "ano").alias("a"), partition_value("p", "mes").alias("m")).collect()
    assert (rows[0].a, rows[0].m) == (2024, 3)
    assert (rows[1].a, rows[1].m) == (None, 1)


ODD_PATHS = ["ano=2024/mes=1", "/a/ano=/ano=2020/f", "/a/ano=x/ano=2021/f", "/a/ano=12x/f", "/a/xano=2024/f", "/a/ano=2024",
             "/a/ano= 7/f", "/a/ano=+7/f", "/a/ano=-7/f", "/ano=1/ano=2/f", "", "/", "ano=", "/a/ano=5\n", "/a/ano=007/f", "/a/ANO=3/f", None]
ODD_NAMES = ["PACE0000", "PACE9912", "PACE0010x", " PACE2401", "PACÉ2401", "PACE24٠1", "PA\nE2401", "PACE2401\n", "x\nPACE2401", "PACE240", "", None]


def test_month_helpers_read_each_path_and_name_cheaply(spark):
    """The same values as of a search of the whole text and a date parser, which
    no row of the usual form goes through."""
    paths = spark.createDataFrame([(i, p) for i, p in enumerate(ODD_PATHS)], "i int, p string")
    raw = F.regexp_extract("p", r"(?:^|/)ano=(\d+)(?:/|$)", 1)
    got = paths.select("p", partition_value("p", "ano").alias("a"), F.when(raw != "", raw.cast("int")).alias("b"))
    assert all(r.a == r.b for r in got.collect()) and got.where("a IS NOT NULL").count() == 7
    names = spark.createDataFrame([(n,) for n in ODD_NAMES], "p string")
    part = [F.regexp_extract("p", r"^([A-Za-z]{2})([A-Za-z]{2})(\d{2})(\d{2})", k) for k in (3, 4)]
    got = names.select("p", source_month_date("p").alias("a"),
                       F.try_to_date(F.concat(F.lit("20"), part[0], F.lit("-"), part[1]), "yyyy-MM").alias("b"))
    assert all(r.a == r.b for r in got.collect()) and got.where("a IS NOT NULL").count() == 3

    def plan(c):
        return paths.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan(source_month_date("p"))
    text = plan(partition_value("p", "ano"))
    assert text.startswith("Project [") and text.index("translate(substring_index(") < text.index("regexp_extract(")

"""Differential test: random bronze rows through silver + rollup in Spark
against the same rules written as DuckDB SQL over the same rows."""
import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import monthly_facts as mf
from monthly_facts import schema as S
from tests.conftest import bronze_rows

NAMES = st.sampled_from(["PACE2401", "PACE2402", "PASP2312", "pace2403", "PACE2401a",
                         "PACE2413", "PACEXXYY", "PACE24", None])
CODES = st.sampled_from(["1", "01", "2", None])
MONEY = st.one_of(st.none(), st.integers(0, 10**7).map(lambda c: f"{c // 100}.{c % 100:02d}"))
QTY = st.one_of(st.none(), st.integers(-5, 1000).map(str))
COLUMNS = ["arquivo_origem", "PA_CODUNI", "PA_MUNPCN", "PA_PROC_ID",
           "PA_VALPRO", "PA_VALAPR", "PA_QTDPRO", "PA_QTDAPR"]
ROW = st.fixed_dictionaries({
    "arquivo_origem": NAMES, "PA_CODUNI": CODES, "PA_MUNPCN": CODES, "PA_PROC_ID": CODES,
    "PA_VALPRO": MONEY, "PA_VALAPR": MONEY, "PA_QTDPRO": QTY, "PA_QTDAPR": QTY,
})

ORACLE = r"""
WITH silver AS (
  SELECT *, CAST(year(data_ref) AS INTEGER) Ano, monthname(data_ref) Mes FROM (
    SELECT *, CAST(try_strptime('20' || regexp_extract(arquivo_origem, '^([A-Za-z]{2})([A-Za-z]{2})(\d{2})(\d{2})', 3)
             || '-' || regexp_extract(arquivo_origem, '^([A-Za-z]{2})([A-Za-z]{2})(\d{2})(\d{2})', 4), '%Y-%m') AS DATE) data_ref
    FROM rows) WHERE data_ref IS NOT NULL)
SELECT PA_CODUNI, Ano, Mes, data_ref, PA_MUNPCN, PA_PROC_ID,
       round(sum(CAST(PA_VALPRO AS DOUBLE)), 2) PA_VALPRO, round(sum(CAST(PA_VALAPR AS DOUBLE)), 2) PA_VALAPR,
       CAST(sum(CAST(PA_QTDPRO AS BIGINT)) AS BIGINT) PA_QTDPRO, CAST(sum(CAST(PA_QTDAPR AS BIGINT)) AS BIGINT) PA_QTDAPR
FROM silver GROUP BY ALL
"""


def canon(rows):
    return sorted(tuple("" if v is None else (f"{v:.2f}" if isinstance(v, float) else str(v)) for v in r)
                  for r in rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=0, max_size=40))
def test_rollup_matches_bruteforce(spark, rows):
    bronze = bronze_rows(spark, rows)
    got = mf.rollup(mf.derive_silver(bronze)).collect()
    frame = pd.DataFrame(rows, columns=COLUMNS, dtype=object)
    con = duckdb.connect()
    con.register("rows_df", frame)
    con.execute("CREATE TABLE rows AS SELECT " + ", ".join(
        f"CAST({c} AS VARCHAR) {c}" for c in frame.columns) + " FROM rows_df")
    want = con.execute(ORACLE).fetchall()
    assert canon([tuple(r[c] for c in S.GOLD_COLUMNS) for r in got]) == canon(want)


GOLD_DDL = ("PA_CODUNI string, Ano int, Mes string, data_ref date, PA_MUNPCN string, PA_PROC_ID string, "
            "PA_VALPRO double, PA_VALAPR double, PA_QTDPRO bigint, PA_QTDAPR bigint")
MONTHS = st.sampled_from([(2023, 12), (2024, 1), (2024, 2), (2024, 3)])
GOLD_ROW = st.tuples(CODES, MONTHS, CODES, CODES,
                     st.one_of(st.none(), st.integers(0, 10**6).map(lambda c: c / 100)),
                     st.one_of(st.none(), st.integers(0, 100)))
FILTER = st.one_of(st.none(), st.lists(st.sampled_from(["1", "01", "2", "9"]), max_size=3))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(GOLD_ROW, max_size=30), st.one_of(st.none(), st.lists(st.sampled_from([2023, 2024]), max_size=2)),
       st.one_of(st.none(), st.lists(st.sampled_from(["January", "March", "December"]), max_size=2)),
       FILTER, FILTER, FILTER)
def test_monthly_totals_matches_bruteforce(spark, rows, anos, meses, muns, facs, procs):
    import datetime as dt
    names = {1: "January", 2: "February", 3: "March", 12: "December"}
    data = [(f, y, names[m], dt.date(y, m, 1), mu, p, v, v, q, q) for f, (y, m), mu, p, v, q in rows]
    gold = spark.createDataFrame(data, GOLD_DDL)
    got = mf.monthly_totals(gold, anos=anos, meses=meses, municipios=muns,
                            estabelecimentos=facs, procedimentos=procs).collect()
    con = duckdb.connect()
    con.register("g_df", pd.DataFrame(data, columns=[c.split()[0] for c in GOLD_DDL.split(", ")]))
    where = []
    for col, vals in (("Ano", anos), ("Mes", meses), ("PA_MUNPCN", muns), ("PA_CODUNI", facs), ("PA_PROC_ID", procs)):
        if vals:
            where.append(f"{col} IN ({', '.join(repr(v) for v in vals)})")
    sql = ("SELECT CAST(data_ref AS DATE), round(sum(PA_VALPRO), 2), round(sum(PA_VALAPR), 2), "
           "CAST(sum(PA_QTDPRO) AS BIGINT), CAST(sum(PA_QTDAPR) AS BIGINT) FROM g_df "
           + ("WHERE " + " AND ".join(where) if where else "") + " GROUP BY 1")
    want = con.execute(sql).fetchall()
    assert canon([tuple(r) for r in got]) == canon(want)
    assert [r.data_ref for r in got] == sorted(r.data_ref for r in got)

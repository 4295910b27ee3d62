"""Nothing is left out without a word: unreadable files, missing columns, bad
measures, long lists, large answers."""
import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import monthly_facts as mf
from monthly_facts import schema as S
from monthly_facts.operators.filters import keep_members
from monthly_facts.plans import ingest as ingest_module
from monthly_facts.sources import testdata as TD
from monthly_facts.sources.survey import REQUIRED, survey
from tests.conftest import SF_SMALL, bronze_rows

TODAY = dt.date(2024, 6, 10)
ROW = {"PA_CODUNI": "1", "PA_MUNPCN": "7", "PA_PROC_ID": "p", "PA_VALPRO": "2.00", "PA_VALAPR": "1.00", "PA_QTDPRO": "2", "PA_QTDAPR": "1"}


def put(root, source, rows=1, name="a.parquet", **columns):
    os.makedirs(os.path.join(root, source), exist_ok=True)
    data = {c: [ROW[c]] * rows for c in REQUIRED} | columns
    pq.write_table(pa.table({k: v for k, v in data.items() if v is not None}), os.path.join(root, source, name))


@pytest.fixture
def tree(workdir):
    root = os.path.join(workdir, "tree")
    put(root, "PACE2401", 50)
    put(root, "PACE2401b", 50)
    with open(os.path.join(root, "PACE2401b", "a.parquet"), "r+b") as f:
        f.truncate(os.path.getsize(f.name) // 2)
    put(root, "PACE2402", 3, PA_QTDPRO=pa.array([1, 2, 3], pa.int64()))
    put(root, "PACE2403", 4, PA_VALPRO=None)
    put(root, "PACE2404", 5)
    return root


def test_tree_is_strict(spark, tree):
    with pytest.raises(ValueError, match="PACE2401b.*unreadable.*PACE2402.*not text: PA_QTDPRO.*PACE2403.*lacks PA_VALPRO"):
        mf.read_bronze_tree(spark, tree)
    with pytest.raises(ValueError, match="PACE2403"):
        mf.read_bronze_tree(spark, tree, exclude=["PACE2401b", "PACE2402"])
    problems = mf.tree_problems(spark, tree)
    assert sorted(r.arquivo_origem for r in problems.collect()) == ["PACE2401b", "PACE2402", "PACE2403"]
    good = mf.read_bronze_tree(spark, tree, exclude=problems)
    assert sorted((r.arquivo_origem, r["count"]) for r in good.groupBy("arquivo_origem").count().collect()) == [("PACE2401", 50), ("PACE2404", 5)]
    assert all(t == "string" for _, t in good.dtypes)


def test_months_of_unreadable_sources_fail_and_stay_pending(spark, tree, workdir):
    lay = mf.Layout(workdir)
    problems = mf.tree_problems(spark, tree)
    mf.land_bronze(mf.read_bronze_tree(spark, tree, exclude=problems), lay.bronze, rebalance=False)
    report = mf.ingest(spark, mf.read_bronze(spark, lay.bronze), lay, TODAY, start=(2024, 1), unreadable=problems)
    log = {(r.ano, r.mes): (r.status, r.detalhe) for r in report.log.collect()}
    assert {m: s for m, (s, _) in log.items()} == {(2024, 1): "failed", (2024, 2): "failed", (2024, 3): "failed", (2024, 4): "ok"}
    assert "PACE2401b" in log[2024, 1][1] and "PA_VALPRO" in log[2024, 3][1]
    assert mf.month_folders(spark, lay.gold) == [(2024, 4)]
    put(tree, "PACE2401b", 50)
    put(tree, "PACE2402", 3)
    put(tree, "PACE2403", 4)
    mf.land_bronze(mf.read_bronze_tree(spark, tree), lay.bronze, rebalance=False)
    mf.ingest(spark, mf.read_bronze(spark, lay.bronze), lay, TODAY, start=(2024, 1))
    assert mf.read_gold(spark, lay.gold).agg(F.sum("PA_VALPRO")).first()[0] == 2.0 * (100 + 3 + 4 + 5)


def put_csv(root, source, text, name="a.csv"):
    os.makedirs(os.path.join(root, source), exist_ok=True)
    with open(os.path.join(root, source, name), "w", encoding="latin-1") as f:
        f.write(text)


HEAD = "PA_CODUNI,PA_MUNPCN,PA_PROC_ID,PA_VALPRO,PA_VALAPR,PA_QTDPRO,PA_QTDAPR"


@pytest.fixture
def csv_tree(workdir):
    root = os.path.join(workdir, "csv")
    put_csv(root, "PACE2401", HEAD + "\n001,7,p,200.00,100.00,2,1\n")
    put_csv(root, "PACE2401b", "PA_QTDAPR,PA_VALAPR,PA_VALPRO,PA_QTDPRO,PA_PROC_ID,PA_MUNPCN,PA_CODUNI\r\n1,100.00,200.00,2,p,7,001\r\n")
    put_csv(root, "PACE2402", HEAD.replace(",PA_VALAPR", "") + "\n001,7,p,200.00,2,1\n")                # lacks a measure
    put_csv(root, "PACE2403", HEAD + "\n001,7,p,200.00,100.00,2,1\n001,7,p,200.00\n1,2,3,4,5,6,7,8\n")   # a short and a long row
    put_csv(root, "PACE2404", 'OUTRA,"PA_CMP",' + HEAD + ',PA_VALPRO\n"a, b",São,001,7,p,200.00,100.00,2,1,9.99\n')
    put_csv(root, "PACE2404", "", "empty.csv")
    return root


def test_csv_files_are_read_under_their_own_headers(spark, csv_tree):
    with pytest.raises(ValueError, match="PACE2402.*lacks PA_VALAPR"):
        mf.read_bronze_tree(spark, csv_tree, "csv")
    with pytest.raises(Exception, match="PACE2403"):
        mf.read_bronze_tree(spark, csv_tree, "csv", exclude=["PACE2402"]).collect()
    with pytest.raises(Exception, match="PACE2403"):   # whatever columns are asked for
        mf.read_bronze_tree(spark, csv_tree, "csv", exclude=["PACE2402"]).select("PA_CODUNI").collect()
    problems = mf.tree_problems(spark, csv_tree, "csv", encoding="ISO-8859-1")
    told = {r.arquivo_origem: r.erro for r in problems.collect()}
    assert told == {"PACE2402": "lacks PA_VALAPR", "PACE2403": "2 rows do not fit the header, e.g. '001,7,p,200.00'"}
    good = mf.read_bronze_tree(spark, csv_tree, "csv", exclude=problems, encoding="ISO-8859-1")
    rows = {r.arquivo_origem: r.asDict() for r in good.collect()}
    assert set(rows) == {"PACE2401", "PACE2401b", "PACE2404"}
    for r in rows.values():
        assert (r["PA_CODUNI"], r["PA_VALPRO"], r["PA_VALAPR"], r["PA_QTDPRO"], r["PA_QTDAPR"]) == ("001", "200.00", "100.00", "2", "1")
    assert rows["PACE2404"]["PA_CMP"] == "São" and rows["PACE2401"]["PA_CMP"] is None
    assert good.columns == [*S.COLUMNS_OF_INTEREST, S.SOURCE_COL]


def test_csv_command_line_reports_bad_sources(spark, csv_tree, workdir):
    from monthly_facts.__main__ import main

    root = os.path.join(workdir, "out")
    assert main(["--root", root, "--start", "2024-01", "--today", "2024-06-10", "--extracts", csv_tree, "--extracts-format", "csv",
                 "--extracts-encoding", "ISO-8859-1"]) == 1
    assert mf.month_folders(spark, mf.Layout(root).gold) == [(2024, 1), (2024, 4)]
    assert mf.read_gold(spark, mf.Layout(root).gold).where("Mes = 'January'").agg(F.sum("PA_VALPRO"), F.sum("PA_VALAPR")).first()[:] == (400.0, 200.0)


def test_footers_are_looked_up_in_tasks(spark, tree):
    found = survey(spark, tree)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    assert {r.arquivo_origem: (r.colunas is None, r.erro and r.erro.split(" ")[0]) for r in found.collect()} == {
        "PACE2401": (False, None), "PACE2401b": (True, "unreadable:"), "PACE2402": (False, "not"), "PACE2403": (False, "lacks"), "PACE2404": (False, None)}


def test_command_line_lands_a_tree(spark, tree, workdir):
    from monthly_facts.__main__ import main

    root = os.path.join(workdir, "out")
    assert main(["--root", root, "--start", "2024-01", "--today", "2024-06-10", "--extracts", tree, "--endpoint", "http://store.local:9000"]) == 1
    assert mf.month_folders(spark, mf.Layout(root).gold) == [(2024, 4)]


def test_landing_needs_keys_and_measures(spark, workdir):
    with pytest.raises(ValueError, match="PA_VALPRO"):
        mf.land_bronze(bronze_rows(spark, [dict(ROW, arquivo_origem="PACE2401")]).drop("PA_VALPRO"), workdir)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_measure_fails_whatever_the_ansi_setting(spark, workdir, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [dict(ROW, PA_VALPRO=v, arquivo_origem="PACE2401") for v in ("x", "5", "5")] + [dict(ROW, arquivo_origem="PACE2402")]
        bronze = bronze_rows(spark, rows)
        with pytest.raises(Exception, match="PA_VALPRO is not a number: x"):
            mf.rollup(mf.derive_silver(bronze)).collect()
        report = mf.ingest(spark, bronze, mf.Layout(workdir), TODAY, start=(2024, 1), end=(2024, 2))
        assert [(r.mes, r.status, r.detalhe) for r in report.log.collect()] == [
            (1, "failed", "PA_VALPRO: 1 values are not numbers, e.g. 'x'"), (2, "ok", None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def counting(spark, df):
    """``df`` and an accumulator of the rows that were read of it."""
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch
    return df.mapInArrow(count, df.schema), rows


def test_a_run_reads_the_facts_once(spark, workdir):
    rows = [dict(ROW, arquivo_origem=f"PACE23{m:02d}") for m in range(1, 13) for _ in range(5)]
    facts, read = counting(spark, bronze_rows(spark, rows))
    report = mf.run_monthly(spark, facts, mf.Layout(workdir), TODAY, start=(2023, 1))
    assert report.succeeded == 12 and read.value == 60


def test_only_bad_months_are_read_again(spark, workdir):
    rows = [dict(ROW, arquivo_origem=f"PACE23{m:02d}") for m in range(1, 13)] + [dict(ROW, PA_QTDAPR="?", arquivo_origem="PACE2307")]
    lay = mf.Layout(workdir)
    mf.land_bronze(bronze_rows(spark, rows), lay.bronze)
    seen = []
    real = ingest_module.bad_measures
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ingest_module, "bad_measures", lambda silver, r: seen.append(silver.select("data_ref").distinct().collect()) or real(silver, r))
        report = mf.ingest(spark, mf.read_bronze(spark, lay.bronze), lay, TODAY, start=(2023, 1))
    assert [[r[0].month for r in x] for x in seen] == [[7]]
    assert [r.detalhe for r in report.log.where("status = 'failed'").collect()] == ["PA_QTDAPR: 1 values are not numbers, e.g. '?'"]
    assert (2023, 7) not in mf.month_folders(spark, lay.gold) and len(mf.month_folders(spark, lay.gold)) == 11


def test_an_unrelated_failure_is_not_swallowed(spark, workdir, monkeypatch):
    lay = mf.Layout(workdir)
    calls = []
    monkeypatch.setattr(ingest_module, "write_month_partitions", lambda *a, **k: calls.append(1) or (_ for _ in ()).throw(OSError("disk full")))
    rows = [dict(ROW, arquivo_origem=f"PACE23{m:02d}") for m in range(1, 13)]
    with pytest.raises(OSError, match="disk full"):
        mf.ingest(spark, bronze_rows(spark, rows), lay, TODAY, start=(2023, 1))
    assert calls == [1]


def test_short_and_long_lists_agree(spark):
    df = spark.createDataFrame([("0012345",), ("12345",), ("12345",), ("abc",), (None,)], "PA_CODUNI string")
    one = keep_members(df, "PA_CODUNI", [12345]).collect()
    many = keep_members(df, "PA_CODUNI", [12345, *range(1_000_000, 1_006_000)]).collect()
    frame = keep_members(df, "PA_CODUNI", spark.range(12345, 12346)).collect()
    assert [r[0] for r in one] == [r[0] for r in many] == [r[0] for r in frame] == ["12345", "12345"]
    assert keep_members(df, "PA_CODUNI", []).count() == 5
    assert keep_members(df, "PA_CODUNI", spark.range(0)).count() == 0


def test_large_answers_are_refused_not_cut(spark):
    with pytest.raises(ValueError, match="more than 10 rows"):
        mf.to_list(spark.range(11), max_rows=10)
    assert mf.to_list(spark.range(10), max_rows=10) == list(range(10))


def test_facility_filter_is_a_text_predicate(spark):
    plan = mf.derive_silver(TD.bronze_from_tables(spark, SF_SMALL), facilities=["1", "2"])._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(l_suppkey" in plan and "IN (1,2)" in plan
    assert all(dict(TD.bronze_from_tables(spark, SF_SMALL).dtypes)[c] == "string" for c in S.COLUMNS_OF_INTEREST)

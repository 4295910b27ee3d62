"""What travels through the shuffles and sorts of the writes."""
import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
import monthly_facts as mf
from monthly_facts import schema as S
from monthly_facts.sources import testdata as TD
from monthly_facts.streaming import run_stream_once
from tests.conftest import SF_SMALL, bronze_rows

ROW = {"PA_CODUNI": "1", "PA_MUNPCN": "2", "PA_PROC_ID": "3", "PA_VALPRO": "1.50", "PA_VALAPR": "1.00", "PA_QTDPRO": "2", "PA_QTDAPR": "1"}


@pytest.fixture
def written_plans(monkeypatch):
    """Optimized plans of the frames that are written as Parquet, which still are."""
    plans, real = [], DataFrameWriter.parquet

    def parquet(self, path, *a, **k):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return real(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


def below(plan: str, node: str) -> str:
    assert node in plan
    return plan.split(node, 1)[1]


def test_landing_shuffles_no_column_that_is_null_throughout(spark, workdir, written_plans):
    bronze = TD.bronze_from_tables(spark, SF_SMALL)
    mf.land_bronze(bronze, workdir)
    assert "null AS PA_SEXO" in written_plans[0] and "null AS" not in below(written_plans[0], "Sort")
    read = mf.read_bronze(spark, workdir)
    assert read.select(*bronze.columns).exceptAll(bronze).isEmpty() and read.count() == bronze.count()


def test_gold_is_named_behind_its_shuffle(spark, workdir, written_plans):
    layout, bronze = mf.Layout(workdir), bronze_rows(spark, [dict(ROW, arquivo_origem=f"PACE23{m:02d}") for m in (1, 2)])
    mf.land_bronze(bronze, layout.bronze)
    mf.ingest(spark, mf.read_bronze(spark, layout.bronze), layout, dt.date(2023, 9, 1), start=(2023, 1))
    run_stream_once(spark, layout.bronze, workdir + "/stream", workdir + "/checkpoint")
    gold = [p for p in written_plans if "AS Mes" in p]
    assert len(gold) == 2 and all("AS Mes" not in below(p, "Sort") for p in gold)
    rows = sorted(mf.read_gold(spark, layout.gold).select(*S.GOLD_COLUMNS).collect())
    assert {(r.Ano, r.Mes, r.PA_VALPRO) for r in rows} == {(2023, "January", 1.5), (2023, "February", 1.5)}
    assert rows == sorted(mf.read_gold(spark, workdir + "/stream").select(*S.GOLD_COLUMNS).collect())


def test_a_path_that_is_no_folder_fails_before_anything_is_read(spark, workdir):
    gold = mf.rollup(mf.derive_silver(bronze_rows(spark, [dict(ROW, arquivo_origem="PACE2301")])))
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    open(workdir + "/file", "w").close()
    with pytest.raises(Exception):
        mf.write_month_partitions(gold.mapInArrow(count, gold.schema), workdir + "/file")
    assert read.value == 0


def test_positions_do_not_shuffle_rows(spark, workdir):
    gold = mf.rollup(mf.derive_silver(bronze_rows(spark, [dict(ROW, arquivo_origem=f"PACE23{m:02d}") for m in (1, 2)])))
    mf.write_month_partitions(gold, workdir + "/gold")
    mf.consolidate(spark, workdir + "/gold", workdir + "/all")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entry._file_positions(spark, workdir + "/all", S.DATE_COL)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert [r.ord for r in found.orderBy(S.DATE_COL).collect()] == [1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("build", ["_csv_tree", "_broken_tree"])
def test_trees_are_built_from_one_join(spark, monkeypatch, build):
    joined, landed = [], entry._landed_bronze(spark, SF_SMALL)
    assert "Join" not in landed._jdf.queryExecution().optimizedPlan().toString()
    bronze = TD.bronze_from_tables(spark, SF_SMALL)
    assert landed.columns == bronze.columns and landed.exceptAll(bronze).isEmpty() and landed.count() == bronze.count()
    real = TD.extracts_from_tables
    monkeypatch.setattr(TD, "extracts_from_tables", lambda *a: joined.append(1) or real(*a))
    getattr(entry, build)(spark, SF_SMALL)
    assert joined == [1]

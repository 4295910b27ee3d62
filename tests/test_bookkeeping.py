"""Months by listing, safe consolidation, scratch folders, resume."""
import datetime as dt
import glob
import os

import pytest

import monthly_facts as mf
from monthly_facts import schema as S
from monthly_facts import session
from tests.conftest import bronze_rows
from tests.test_no_silent_loss import ROW

TODAY = dt.date(2024, 6, 10)


def landed(spark, root, names):
    lay = mf.Layout(root)
    mf.land_bronze(bronze_rows(spark, [dict(ROW, arquivo_origem=n) for n in names]), lay.bronze)
    return lay, mf.read_bronze(spark, lay.bronze)


def test_a_run_with_nothing_to_do_reads_no_table(spark, workdir):
    lay, bronze = landed(spark, workdir, ["PACE2401", "PACE2402", "PACE2403", "PACE2404"])
    mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1))
    for f in glob.glob(os.path.join(workdir, "**", "*.parquet"), recursive=True):
        os.truncate(f, 5)                                          # to open any of them is an error
    bronze = mf.read_bronze(spark, lay.bronze)
    report = mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1), lag=1)   # one month is pending, no source names it
    assert [(r.mes, r.status) for r in report.log.collect()] == [(5, "no_data")]


def test_empty_gold_folder_is_no_gold(spark, workdir):
    lay, bronze = landed(spark, workdir, ["PACE2401"])
    os.makedirs(lay.gold)
    assert mf.read_gold(spark, lay.gold).count() == 0
    report = mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1))
    assert report.succeeded == 1


def files(path):
    """Data files by month folder."""
    found = {}
    for f in glob.glob(os.path.join(path, "*", "*", "*.parquet")):
        found.setdefault(os.path.dirname(f)[len(path):], set()).add(f)
    return found


def test_landing_one_month_rewrites_one_month(spark, workdir):
    lay, bronze = landed(spark, workdir, ["PACE2401", "PACE2403"])
    mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1))
    before = files(lay.consolidated)
    lay, bronze = landed(spark, workdir, ["PACE2402"])
    mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1))
    after = files(lay.consolidated)
    assert len(after) == 3 and all(after[m] == before[m] for m in before)
    assert mf.read_consolidated(spark, lay.consolidated).count() == spark.read.parquet(lay.consolidated).count() == 3
    assert mf.consolidate(spark, lay.gold, lay.consolidated) == []
    assert mf.consolidate(spark, lay.gold, lay.consolidated, [(2024, 2)]) == [(2024, 2)]
    assert mf.consolidate(spark, lay.gold, lay.consolidated, force=True) == [(2024, 1), (2024, 2), (2024, 3)]
    assert spark.read.parquet(lay.consolidated).count() == 3


def test_a_failed_consolidation_leaves_the_old_table(spark, workdir):
    lay, bronze = landed(spark, workdir, ["PACE2401"])
    mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1))
    lay, bronze = landed(spark, workdir, ["PACE2402"])
    mf.ingest(spark, bronze, lay, TODAY, start=(2024, 1))
    (cut,) = files(lay.gold)[f"/{S.PART_YEAR}=2024/{S.PART_MONTH}=2"]
    whole = open(cut, "rb").read()
    os.truncate(cut, 5)
    with pytest.raises(Exception):
        mf.consolidate(spark, lay.gold, lay.consolidated)
    assert [r.Mes for r in mf.read_consolidated(spark, lay.consolidated).collect()] == ["January"]
    with open(cut, "wb") as f:
        f.write(whole)
    assert mf.consolidate(spark, lay.gold, lay.consolidated) == [(2024, 2)]
    assert sorted(r.Mes for r in mf.read_consolidated(spark, lay.consolidated).collect()) == ["February", "January"]


def test_force_drops_months_that_gold_has_no_longer(spark, workdir):
    lay, bronze = landed(spark, workdir, ["PACE2401", "PACE2402"])
    mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1))
    os.rename(os.path.join(lay.gold, f"{S.PART_YEAR}=2024", f"{S.PART_MONTH}=1"), os.path.join(workdir, "away"))
    assert mf.consolidate(spark, lay.gold, lay.consolidated, force=True) == [(2024, 2)]
    assert [r.Mes for r in spark.read.parquet(lay.consolidated).collect()] == ["February"]


def test_consolidated_of_another_tool_counts(spark, workdir):
    from monthly_facts.plans.ingest import consolidated_exists

    lay, bronze = landed(spark, workdir, ["PACE2401"])
    assert not consolidated_exists(spark, lay)
    mf.write_table(mf.rollup(mf.derive_silver(bronze)), lay.consolidated)
    for f in glob.glob(os.path.join(lay.consolidated, "_SUCCESS")):
        os.rename(f, os.path.join(workdir, "success-marker"))
    assert consolidated_exists(spark, lay) and mf.read_consolidated(spark, lay.consolidated).count() == 1


def test_resume_needs_no_bronze_for_stored_silver(spark, workdir):
    class NoGold(mf.Layout):
        @property
        def gold(self):
            return self._p("file")

    lay, bronze = landed(spark, workdir, ["PACE2401", "PACE2402"])
    open(os.path.join(workdir, "file"), "w").close()
    with pytest.raises(Exception):
        mf.ingest(spark, bronze, NoGold(workdir), TODAY, start=(2024, 1), keep_silver=True)
    assert mf.month_folders(spark, lay.silver) == [(2024, 1), (2024, 2)] and mf.month_folders(spark, lay.gold) == []
    report = mf.ingest(spark, bronze.where("false"), lay, TODAY, start=(2024, 1), keep_silver=True)
    assert report.succeeded == 2 and mf.month_folders(spark, lay.gold) == [(2024, 1), (2024, 2)]


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, setting=None):
        self.sparkContext, self.setting = _Context(master), setting

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        return self.setting if key == "spark.checkpoint.dir" else default


def test_scratch_folder_is_shared_or_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(_Session(master))
        assert session.shared_dir(_Session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert session.shared_dir(_Session("local[4]")).startswith("/")


def test_local_session_sets_the_folder_itself(spark):
    assert spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    assert S.GOLD_COLUMNS  # the session serves the library's tables

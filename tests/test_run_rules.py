"""Start-month choice, gap healing and the consolidation / dimension rules."""
import datetime as dt
import os
import shutil

import monthly_facts as mf
from tests.conftest import bronze_rows

TODAY = dt.date(2024, 6, 10)   # months up to 2024-04 are available


def rows_for(*names):
    base = {"PA_CODUNI": "1", "PA_MUNPCN": "7", "PA_PROC_ID": "p", "PA_VALPRO": "2.00",
            "PA_VALAPR": "1.00", "PA_QTDPRO": "2", "PA_QTDAPR": "1"}
    return [dict(base, arquivo_origem=n) for n in names]


def statuses(report):
    return {(r.ano, r.mes): r.status for r in report.log.collect()}


def test_gap_heals_by_default_but_not_after_latest(spark, workdir):
    a, b = mf.Layout(os.path.join(workdir, "a")), mf.Layout(os.path.join(workdir, "b"))
    for lay in (a, b):
        mf.land_bronze(bronze_rows(spark, rows_for("PACE2401", "PACE2403")), lay.bronze)
        first = mf.ingest(spark, mf.read_bronze(spark, lay.bronze), lay, TODAY, start=(2024, 1))
        assert statuses(first) == {(2024, 1): "ok", (2024, 2): "no_data", (2024, 3): "ok", (2024, 4): "no_data"}
        # February arrives late.
        mf.land_bronze(bronze_rows(spark, rows_for("PACE2402")), lay.bronze)
    healed = mf.ingest(spark, mf.read_bronze(spark, a.bronze), a, TODAY, start=(2024, 1))
    assert statuses(healed) == {(2024, 2): "ok", (2024, 4): "no_data"}
    skipped = mf.ingest(spark, mf.read_bronze(spark, b.bronze), b, TODAY, after_latest=True)
    assert statuses(skipped) == {(2024, 4): "no_data"}


def test_consolidation_and_dimension_rules(spark, workdir):
    lay = mf.Layout(workdir)
    mf.land_bronze(bronze_rows(spark, rows_for("PACE2401")), lay.bronze)
    bronze = mf.read_bronze(spark, lay.bronze)
    labels = spark.createDataFrame([("1", "Unit One")], "CNES string, FANTASIA string")
    r1 = mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1), facility_labels=labels)
    assert r1.consolidated and r1.dims_refreshed
    r2 = mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1), facility_labels=labels)
    assert not r2.consolidated and not r2.dims_refreshed          # nothing new
    r3 = mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1), force_consolidate=True)
    assert r3.consolidated and not r3.dims_refreshed
    shutil.rmtree(lay.consolidated)                                # consolidated lost
    r4 = mf.run_monthly(spark, bronze, lay, TODAY, start=(2024, 1), skip_dims=True)
    assert r4.consolidated and not r4.dims_refreshed
    assert mf.read_consolidated(spark, lay.consolidated).count() == 1


def test_end_bound_limits_a_run(spark, workdir):
    lay = mf.Layout(workdir)
    mf.land_bronze(bronze_rows(spark, rows_for("PACE2401", "PACE2402", "PACE2403")), lay.bronze)
    r = mf.ingest(spark, mf.read_bronze(spark, lay.bronze), lay, TODAY, start=(2024, 1), end=(2024, 2))
    assert statuses(r) == {(2024, 1): "ok", (2024, 2): "ok"}
    assert [(x.ano, x.mes) for x in mf.landed_months(mf.read_gold(spark, lay.gold)).orderBy("ano", "mes").collect()] \
        == [(2024, 1), (2024, 2)]

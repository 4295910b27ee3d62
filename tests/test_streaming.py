import os

from pyspark.sql import functions as F

import monthly_facts as mf
from monthly_facts import schema as S
from monthly_facts.functions.months import source_month_date
from monthly_facts.sources import testdata as TD
from monthly_facts.streaming import run_stream_once
from tests.conftest import SF_SMALL


def test_stream_lands_new_months_and_late_files(spark, workdir):
    bronze_path = os.path.join(workdir, "bronze")
    gold_path = os.path.join(workdir, "gold")
    ckpt = os.path.join(workdir, "ckpt")
    src = TD.bronze_from_tables(spark, SF_SMALL).withColumn("_d", source_month_date(S.SOURCE_COL))
    early = src.where(F.col("_d") < "2097-01-01").drop("_d")
    late = src.where(F.col("_d") >= "2097-01-01").drop("_d")

    mf.land_bronze(early, bronze_path)
    run_stream_once(spark, bronze_path, gold_path, ckpt)
    n_early = mf.landed_months(mf.read_gold(spark, gold_path)).count()

    # New months arrive, plus a late extra file for an already-landed month.
    mf.land_bronze(late, bronze_path)
    extra = early.where(F.col(S.SOURCE_COL) == "PACE9503").limit(5).withColumn(S.SOURCE_COL, F.lit("PACE9503"))
    extra.write.mode("append").parquet(os.path.join(bronze_path, "arquivo_origem=PACE9503"))
    run_stream_once(spark, bronze_path, gold_path, ckpt)
    run_stream_once(spark, bronze_path, gold_path, ckpt)   # nothing new: no change

    r2 = lambda df: df.select(*[F.round(c, 2).alias(c) if c in S.VALUE_MEASURES else c
                                for c in S.GOLD_COLUMNS])
    got = r2(mf.read_gold(spark, gold_path))
    want = r2(mf.rollup(mf.derive_silver(mf.read_bronze(spark, bronze_path))))
    assert mf.landed_months(got).count() > n_early
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_in_small_batches_equals_batch_rollup(spark, workdir):
    """One file per micro-batch: months split across batches are still whole."""
    bronze_path = os.path.join(workdir, "bronze")
    gold_path = os.path.join(workdir, "gold")
    src = TD.bronze_from_tables(spark, SF_SMALL).withColumn("_d", source_month_date(S.SOURCE_COL))
    part = src.where((F.col("_d") >= "2096-01-01") & (F.col("_d") < "2096-04-01")).drop("_d")
    mf.land_bronze(part.repartition(6), bronze_path, rebalance=False)   # several files per month
    months = run_stream_once(spark, bronze_path, gold_path, os.path.join(workdir, "ckpt"), max_files_per_trigger=1)
    assert months == [(2096, 1), (2096, 2), (2096, 3)]
    assert run_stream_once(spark, bronze_path, gold_path, os.path.join(workdir, "ckpt")) == []
    r2 = lambda df: df.select(*[F.round(c, 2).alias(c) if c in S.VALUE_MEASURES else c
                                for c in S.GOLD_COLUMNS])
    got = r2(mf.read_gold(spark, gold_path))
    want = r2(mf.rollup(mf.derive_silver(part)))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_each_month_is_recomputed_once_per_drain(spark, workdir, monkeypatch):
    import importlib

    module = importlib.import_module("monthly_facts.streaming.ingest_stream")
    bronze_path, gold_path, ckpt = (os.path.join(workdir, x) for x in ("bronze", "gold", "ckpt"))
    src = TD.bronze_from_tables(spark, SF_SMALL).withColumn("_d", source_month_date(S.SOURCE_COL))
    part = src.where((F.col("_d") >= "2096-01-01") & (F.col("_d") < "2096-03-01")).drop("_d")
    mf.land_bronze(part.repartition(5), bronze_path, rebalance=False)
    computed, real = [], module.refresh_months
    monkeypatch.setattr(module, "refresh_months", lambda s, b, g, months: (computed.extend(months), real(s, b, g, months)))
    module.run_stream_once(spark, bronze_path, gold_path, ckpt, max_files_per_trigger=1)
    assert sorted(computed) == [(2096, 1), (2096, 2)]


def test_notes_survive_a_failure_before_the_refresh(spark, workdir, monkeypatch):
    import importlib

    module = importlib.import_module("monthly_facts.streaming.ingest_stream")
    bronze_path, gold_path, ckpt = (os.path.join(workdir, x) for x in ("bronze", "gold", "ckpt"))
    src = TD.bronze_from_tables(spark, SF_SMALL).where(F.col(S.SOURCE_COL) == "PACE9603")
    mf.land_bronze(src, bronze_path)
    with monkeypatch.context() as m:
        m.setattr(module, "refresh_months", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            module.run_stream_once(spark, bronze_path, gold_path, ckpt)
        except RuntimeError:
            pass
    assert module.run_stream_once(spark, bronze_path, gold_path, ckpt) == [(2096, 3)]
    assert mf.month_folders(spark, gold_path) == [(2096, 3)]

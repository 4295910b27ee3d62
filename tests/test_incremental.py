import datetime as dt

import monthly_facts as mf
from monthly_facts.operators.incremental import month_range


def rows(df):
    return [(r.ano, r.mes) for r in df.collect()]


def test_gap_month_is_pending(spark):
    available = month_range(spark, (2024, 1), (2024, 3))
    landed = spark.createDataFrame([(2024, 1), (2024, 3)], "ano int, mes int")
    assert rows(mf.pending_months(available, landed)) == [(2024, 2)]


def test_available_months_lag_and_end_bound(spark):
    av = mf.available_months(spark, (2023, 11), dt.date(2024, 3, 20))
    assert rows(av) == [(2023, 11), (2023, 12), (2024, 1)]
    empty = spark.createDataFrame([], "ano int, mes int")
    assert rows(mf.pending_months(av, empty, end=(2023, 12))) == [(2023, 11), (2023, 12)]
    assert rows(mf.available_months(spark, (2025, 1), dt.date(2024, 3, 20))) == []


def test_latest_and_start(spark):
    landed = spark.createDataFrame([(2023, 12), (2024, 2), (2023, 1)], "ano int, mes int")
    assert rows(mf.latest_month(landed)) == [(2024, 2)]
    assert mf.start_month(landed, after_latest=True) == (2024, 3)
    assert mf.start_month(landed) == (2018, 1)
    assert mf.start_month(landed, explicit=(2020, 5), after_latest=True) == (2020, 5)


def test_source_files_grid(spark):
    years = spark.createDataFrame([(2009,), (2024,)], "Ano int")
    grid = mf.year_month_grid(years)
    names = [r.arquivo for r in mf.source_files(grid, "PA", "CE").collect()]
    assert len(names) == 24 and "PACE0901.dbc" in names and "PACE2412.dbc" in names

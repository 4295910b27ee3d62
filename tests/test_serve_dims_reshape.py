import datetime as dt

import pytest

import monthly_facts as mf
from monthly_facts import schema as S
from monthly_facts.operators import dims as D
from monthly_facts.operators import reshape as R

GOLD_DDL = ("PA_CODUNI string, Ano int, Mes string, data_ref date, PA_MUNPCN string, PA_PROC_ID string, "
            "PA_VALPRO double, PA_VALAPR double, PA_QTDPRO bigint, PA_QTDAPR bigint")


def gold(spark):
    d = dt.date
    rows = [
        ("1", 2023, "December", d(2023, 12, 1), "10", "a", 1.0, 1.0, 1, 1),
        ("1", 2024, "January", d(2024, 1, 1), "10", "a", 2.0, 1.5, 2, 1),
        ("2", 2024, "January", d(2024, 1, 1), None, "b", 3.0, None, 3, None),
        ("2", 2024, "March", d(2024, 3, 1), "20", "b", 4.0, 4.0, 4, 4),
    ]
    return spark.createDataFrame(rows, GOLD_DDL)


def test_monthly_totals_filters(spark):
    g = gold(spark)
    all_rows = mf.monthly_totals(g).collect()
    assert [r.data_ref for r in all_rows] == [dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    jan = all_rows[1]
    assert (jan.PA_VALPRO, jan.PA_VALAPR, jan.PA_QTDPRO, jan.PA_QTDAPR) == (5.0, 1.5, 5, 1)
    # empty lists are no filter
    assert mf.monthly_totals(g, anos=[], meses=[], municipios=[]).count() == 3
    assert [r.PA_VALPRO for r in mf.monthly_totals(g, anos=[2024], meses=["January"]).collect()] == [5.0]
    assert mf.monthly_totals(g, estabelecimentos=["2"], procedimentos=["b"]).count() == 2


def test_no_rows_match_keeps_schema(spark):
    out = mf.monthly_totals(gold(spark), estabelecimentos=["unknown"])
    assert out.count() == 0
    assert out.columns == ["data_ref"] + S.MEASURES


def test_option_lists(spark):
    g = gold(spark)
    assert mf.to_list(mf.years(g)) == [2023, 2024]
    assert mf.to_list(mf.months_of_years(g, [2023, 2024])) == ["December", "January", "March"]
    assert mf.to_list(mf.municipalities(g)) == ["10", "20", None]
    b = mf.year_bounds(g).first()
    assert (b.lo, b.hi) == (2023, 2024)
    with pytest.raises(ValueError):
        mf.months_of_years(g, [])
    assert mf.shape(mf.monthly_totals(g)) == (3, 5)
    assert len(mf.to_records(mf.preview(mf.monthly_totals(g), 2))) == 2


def test_dimension_and_label_filter(spark):
    labels = spark.createDataFrame(
        [(1, "Alpha"), (1, "Alpha"), (1, "Alpha Two"), (2, None)], "CNES long, FANTASIA string")
    dim = D.facility_dimension(labels)
    assert dim.columns == ["PA_CODUNI", "FANTASIA", "label_estabelecimento"]
    got = sorted((r.PA_CODUNI, r.label_estabelecimento) for r in dim.collect() if r.label_estabelecimento)
    assert got == [("1", "1 - Alpha"), ("1", "1 - Alpha Two")]
    assert [r.label_estabelecimento for r in dim.collect() if r.PA_CODUNI == "2"] == [None]
    g = gold(spark)
    picked = mf.filter_by_labels(g, dim, S.FACILITY, D.FACILITY_LABEL, ["1 - Alpha", "1 - Alpha Two"])
    assert picked.count() == 2          # two labels for one code do not duplicate facts
    assert mf.filter_by_labels(g, dim, S.FACILITY, D.FACILITY_LABEL, []).count() == 4
    assert mf.to_list(mf.label_options(dim, D.FACILITY_LABEL)) == ["1 - Alpha", "1 - Alpha Two", None]


def test_yearly_and_long(spark):
    m = mf.monthly_totals(gold(spark))
    y = {(r.Ano, r.tipo): r.valor for r in mf.yearly_long(m, S.VALUE_MEASURES, R.VALUE_COL).collect()}
    assert y == {(2023, "Produzido"): 1.0, (2023, "Aprovado"): 1.0, (2024, "Produzido"): 9.0, (2024, "Aprovado"): 5.5}
    long = R.value_series(m).collect()
    assert len(long) == 6 and long[0].tipo == "Aprovado"
    mean = mf.pooled_mean(R.value_series(m), R.VALUE_COL).first().media
    assert mean == pytest.approx((1 + 1 + 5 + 1.5 + 4 + 4) / 6)


def test_yearly_all_null_is_zero_and_long_keeps_nulls(spark):
    m = spark.createDataFrame([(dt.date(2024, 1, 1), None, 2.0)], "data_ref date, PA_VALPRO double, PA_VALAPR double")
    y = {r.tipo: r.valor for r in mf.yearly_long(m, S.VALUE_MEASURES, R.VALUE_COL).collect()}
    assert y == {"Produzido": 0.0, "Aprovado": 2.0}
    long = R.value_series(m).collect()
    assert len(long) == 2 and None in [r.valor for r in long]


def test_dashboard_tables(spark):
    g = gold(spark)
    pdim = D.procedure_dimension(spark.createDataFrame([("a", "Proc A"), ("b", "Proc B")], "IP_COD string, IP_DSCR string"))
    t = mf.dashboard_tables(g, procedure_dim=pdim, procedure_labels=["b - Proc B"])
    assert [r.PA_VALPRO for r in t["monthly"].collect()] == [3.0, 4.0]
    assert set(t) >= {"yearly_values", "yearly_quantities", "value_series", "quantity_series", "value_mean", "quantity_mean"}
    rows = mf.collect_tables(t)
    assert set(rows) == set(t) and [r.PA_VALPRO for r in rows["monthly"]] == [3.0, 4.0]
    assert len(rows["value_series"]) == 4
    t["monthly"].unpersist()


def test_long_list_is_a_predicate_and_a_frame_a_semi_join(spark):
    g = gold(spark)
    codes = [str(i) for i in range(6000)]
    out = mf.monthly_totals(g, estabelecimentos=codes)
    assert "LeftSemi" not in out._jdf.queryExecution().optimizedPlan().toString()
    frame = spark.createDataFrame([(c,) for c in codes], "code string")
    joined = mf.monthly_totals(g, estabelecimentos=frame)
    assert "LeftSemi" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert out.collect() == joined.collect() and out.count() == 3


def test_write_records(spark, workdir):
    import json
    import glob
    import os
    out = os.path.join(workdir, "monthly_json")
    mf.write_records(mf.monthly_totals(gold(spark)), out)
    recs = [json.loads(line) for f in glob.glob(os.path.join(out, "part-*")) for line in open(f)]
    assert sorted(r["data_ref"] for r in recs) == ["2023-12-01", "2024-01-01", "2024-03-01"]
    back = mf.read_records(spark, out)
    assert dict(back.dtypes)["data_ref"] == "date"
    assert back.exceptAll(mf.monthly_totals(gold(spark))).count() == 0

"""

``entry(spark)`` runs the flagship query (monthly totals of the rollup) on
sf0.001. ``queries()`` maps every implemented operator to a Spark job over
the shared test tables (adapted to the bronze shape by
``monthly_facts.sources.testdata``), and ``oracle_sql()`` gives the same
answer as DuckDB SQL over the same Parquet files.

Conventions shared by both sides: double sums are rounded to 2 places at the
output (the true sums are whole cents; rounding hides summation order), and
``ord`` columns carry the expected order of small option lists, since the
comparison itself ignores row order.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import monthly_facts as mf
from monthly_facts import schema as S
from monthly_facts.functions.months import month_start, source_month_date
from monthly_facts.operators import dims as D
from monthly_facts.operators import reshape as R
from monthly_facts.session import fresh_dir
from monthly_facts.sources import testdata as TD
from monthly_facts.sources.files import partition_values, rename_folder, write_new

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the filtered test queries.
YEARS = [2098, 2099]
MONTHS = ["January", "March"]
MUNICIPALITIES = ["1", "2", "15"]
FACILITIES = ["1", "2", "3"]
# Ship dates 1995-2001 become 2095-2099 and 2000-2001 under the fixed century,
# so the ingest calendar starts in 2000 and most months in between are empty.
TODAY = _dt.date(2102, 1, 15)
START = (2000, 1)
FIRST_RUN_END = (2098, 12)
PENDING_START = (2095, 1)
PENDING_TODAY = _dt.date(2100, 2, 1)


# ------------------------------------------------------------------ helpers

def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return TD.bronze_from_tables(spark, d)


def _landed_bronze(spark: SparkSession, d: str) -> DataFrame:
    """The same rows landed by source first, for queries that read them more
    than once: the join is done once, and filters on the source prune folders."""
    out = fresh_dir(spark, "extracts")
    mf.land_bronze(TD.extracts_from_tables(spark, d), out)
    return TD.as_bronze(mf.read_bronze(spark, out).select(*TD.EXTRACT_COLUMNS))


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return mf.derive_silver(_bronze(spark, d))


def _gold(spark: SparkSession, d: str) -> DataFrame:
    return mf.rollup(_silver(spark, d))


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    return mf.monthly_sums(_gold(spark, d))


def _r2(df: DataFrame, *cols: str) -> DataFrame:
    cols = cols or tuple(c for c, t in df.dtypes if t == "double")
    return df.select(*[F.round(c, 2).alias(c) if c in cols else F.col(c) for c in df.columns])


def _positioned(df: DataFrame) -> DataFrame:
    """The rows of an ordered result with their 1-based position in it as
    ``ord``: the position is the operator's own, nothing is sorted here."""
    schema = T.StructType(df.schema.fields + [T.StructField("ord", T.LongType())])
    return df.sparkSession.createDataFrame(df.rdd.zipWithIndex().map(lambda x: (*x[0], x[1] + 1)), schema)


def _file_positions(spark: SparkSession, path: str, *columns) -> DataFrame:
    """Rows of the consolidated table with their position: rows of the months
    and files before plus the row's place in its own file."""
    rows = spark.read.parquet(path).select(
        *columns, S.PART_YEAR, S.PART_MONTH, F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    files = [S.PART_YEAR, S.PART_MONTH, "f"]
    # One row per file: few, so one task may order them.
    before = F.coalesce(F.sum("n").over(Window.orderBy(*files).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy(*files).agg(F.count(F.lit(1)).alias("n")).withColumn("s", before)
    # Broadcast, as the rows would else be shuffled with the names of their files.
    return rows.join(F.broadcast(starts), files).withColumn("ord", F.col("s") + F.col("i") + 1).select(*columns, "ord")


def _tree(spark: SparkSession, parts: dict[str, DataFrame], name: str) -> str:
    """A foreign tree ``<root>/<part>/<source name>/file``: partitioned writes
    whose folders are renamed."""
    root, work = fresh_dir(spark, name), fresh_dir(spark, name + "-parts")
    for part, df in parts.items():
        df.write.partitionBy(S.SOURCE_COL).parquet(f"{work}/{part}")
        for (source,) in partition_values(spark, f"{work}/{part}", S.SOURCE_COL):
            rename_folder(spark, f"{work}/{part}/{S.SOURCE_COL}={source}", f"{root}/{part}/{source}")
    return root


def _procedure_dim(spark, d):
    return D.procedure_dimension(TD.procedure_labels(spark, d))


def _facility_dim(spark, d):
    return D.facility_dimension(TD.facility_labels(spark, d))


# --------------------------------------------------------- ingest fixtures

_RUNS: dict[tuple, dict] = {}


def _ingested(spark: SparkSession, d: str) -> dict:
    """Land bronze, then run the monthly job three times (up to 2098-12, then
    the rest, then again with nothing new) into a fresh folder under the
    session's shared scratch folder. Memoised per session and input so the
    read-back queries share one run."""
    key = (id(spark), d)
    if key in _RUNS:
        return _RUNS[key]
    layout = mf.Layout(fresh_dir(spark, "ingest"))
    mf.land_bronze(_bronze(spark, d), layout.bronze)
    bronze = mf.read_bronze(spark, layout.bronze)
    kw = dict(facility_labels=TD.facility_labels(spark, d),
              procedure_labels=TD.procedure_labels(spark, d))
    first = mf.run_monthly(spark, bronze, layout, TODAY, start=START, end=FIRST_RUN_END, **kw)
    second = mf.run_monthly(spark, bronze, layout, TODAY, start=START, **kw)
    third = mf.run_monthly(spark, bronze, layout, TODAY, start=START, **kw)
    out = {"layout": layout, "runs": [first, second, third]}
    _RUNS[key] = out
    return out


# ------------------------------------------------------------------ queries

def q_silver_rows(spark, d):
    return _silver(spark, d)


def q_silver_facilities(spark, d):
    return mf.derive_silver(_bronze(spark, d), facilities=FACILITIES).select(
        S.FACILITY, S.DATE_COL, "PA_VALPRO")


def q_gold_rollup(spark, d):
    return _r2(_gold(spark, d))


def q_years(spark, d):
    return _positioned(mf.years(_gold(spark, d)))


def q_year_bounds(spark, d):
    return mf.year_bounds(_gold(spark, d))


def q_months_of_years(spark, d):
    return _positioned(mf.months_of_years(_gold(spark, d), YEARS))


def q_municipalities(spark, d):
    return _positioned(mf.municipalities(_gold(spark, d)))


def q_monthly_totals(spark, d):
    return _r2(_positioned(mf.monthly_totals(_gold(spark, d))))


def q_monthly_totals_filtered(spark, d):
    return _r2(mf.monthly_totals(_gold(spark, d), anos=YEARS, meses=MONTHS,
                                 municipios=MUNICIPALITIES, measures=["PA_VALPRO", "PA_QTDPRO"]))


def q_monthly_totals_by_codes(spark, d):
    procs = [str(i) for i in range(1, 400, 3)]
    return _r2(mf.monthly_totals(_gold(spark, d), estabelecimentos=FACILITIES + ["10", "11"],
                                 procedimentos=procs, measures=["PA_VALAPR", "PA_QTDAPR"]))


def q_yearly_totals(spark, d):
    return _r2(mf.yearly_totals(_monthly(spark, d), S.MEASURES))


def q_monthly_preview(spark, d):
    return _r2(mf.preview(mf.monthly_totals(_gold(spark, d)), 3))


def q_facility_dim(spark, d):
    return _facility_dim(spark, d)


def q_procedure_dim(spark, d):
    return _procedure_dim(spark, d)


def q_procedure_options(spark, d):
    return _positioned(mf.label_options(_procedure_dim(spark, d), D.PROCEDURE_LABEL))


def q_totals_by_label(spark, d):
    dim = _procedure_dim(spark, d)
    chosen = dim.where(F.col(D.PROCEDURE_LABEL).like("1% - cold%")).select(D.PROCEDURE_LABEL)
    facts = mf.filter_by_labels(_gold(spark, d), dim, S.PROCEDURE, D.PROCEDURE_LABEL, chosen)
    return _r2(mf.monthly_totals(facts, measures=["PA_VALPRO"]))


def q_totals_by_facility_label(spark, d):
    dim = _facility_dim(spark, d)
    chosen = dim.where(F.col(D.FACILITY_LABEL).like("1%")).select(D.FACILITY_LABEL)
    facts = mf.filter_by_labels(_gold(spark, d), dim, S.FACILITY, D.FACILITY_LABEL, chosen)
    return _r2(mf.monthly_totals(facts, measures=["PA_QTDPRO"]))


def q_yearly_long(spark, d):
    return _r2(_positioned(mf.yearly_long(_monthly(spark, d), S.VALUE_MEASURES, R.VALUE_COL)))


def q_yearly_qty_long(spark, d):
    return mf.yearly_long(_monthly(spark, d), S.QUANTITY_MEASURES, R.QUANTITY_COL)


def q_monthly_value_long(spark, d):
    return _r2(_positioned(R.value_series(_monthly(spark, d))))


def q_monthly_qty_long(spark, d):
    return R.quantity_series(_monthly(spark, d))


def q_pooled_mean(spark, d):
    return _r2(mf.pooled_mean(R.value_series(_monthly(spark, d)), R.VALUE_COL))


def q_pooled_mean_qty(spark, d):
    return _r2(mf.pooled_mean(R.quantity_series(_monthly(spark, d)), R.QUANTITY_COL))


def q_mean_caption(spark, d):
    return mf.mean_caption(mf.pooled_mean(R.value_series(_monthly(spark, d)), R.VALUE_COL))


def _gaps(spark, d):
    """Landed months of the rollup with every June missing."""
    return mf.landed_months(_gold(spark, d)).where(F.col("mes") != 6)


def q_pending_months(spark, d):
    available = mf.available_months(spark, PENDING_START, PENDING_TODAY)
    return mf.month_dates(mf.pending_months(available, _gaps(spark, d)))


def q_pending_months_bounded(spark, d):
    available = mf.available_months(spark, PENDING_START, PENDING_TODAY)
    return mf.month_dates(mf.pending_months(available, _gaps(spark, d), end=FIRST_RUN_END))


def q_latest_month(spark, d):
    return mf.latest_month(mf.landed_months(_gold(spark, d)))


def q_source_grid(spark, d):
    grid = mf.year_month_grid(mf.years(_gold(spark, d)))
    return mf.source_files(grid, TD.TEST_GROUP, TD.TEST_STATE).select("arquivo")


def q_ingest_gold(spark, d):
    layout = _ingested(spark, d)["layout"]
    return _r2(mf.read_gold(spark, layout.gold).select(*S.GOLD_COLUMNS))


def q_filtered_from_gold(spark, d):
    """Served from the stored month partitions; years and months prune folders."""
    gold = mf.read_gold(spark, _ingested(spark, d)["layout"].gold)
    return _r2(mf.monthly_totals(gold, anos=YEARS, meses=MONTHS, municipios=MUNICIPALITIES,
                                 measures=["PA_VALPRO", "PA_QTDPRO"]))


def q_totals_from_consolidated(spark, d):
    cons = mf.read_consolidated(spark, _ingested(spark, d)["layout"].consolidated)
    return _r2(_positioned(mf.monthly_totals(cons)))


def q_dim_records(spark, d):
    """Code and label of both published dimensions."""
    layout = _ingested(spark, d)["layout"]
    fac = mf.read_dimension(spark, layout.facility_dim, S.FACILITY, D.FACILITY_LABEL)
    proc = mf.read_dimension(spark, layout.procedure_dim, S.PROCEDURE, D.PROCEDURE_LABEL)
    return fac.select(F.lit("facility").alias("dim"), F.col(S.FACILITY).alias("code"), F.col(D.FACILITY_LABEL).alias("label")).unionAll(
        proc.select(F.lit("procedure"), S.PROCEDURE, D.PROCEDURE_LABEL))


def q_bad_names_dropped(spark, d):
    """Returned rows get source names that name no month, or none at all."""
    r = F.col("PA_VALAPR") == "0.00"
    bad = F.element_at(F.array(F.lit("PACE2413"), F.lit("PACEXXYY"), F.lit("P1CE2401"), F.lit("")),
                       F.pmod(F.col(S.FACILITY).cast("int"), F.lit(4)) + 1)
    bronze = _bronze(spark, d).withColumn(S.SOURCE_COL, F.when(r, bad).otherwise(F.col(S.SOURCE_COL)))
    return mf.derive_silver(bronze).select(S.FACILITY, S.SOURCE_COL, S.DATE_COL, "PA_VALPRO")


def q_duplicate_columns(spark, d):
    """A second column of the same name, with other values, is dropped."""
    bronze = _bronze(spark, d)
    twice = bronze.select("*", F.lit("second").alias(S.FACILITY), F.lit("second").alias("PA_VALPRO"))
    return mf.derive_silver(twice).select(S.FACILITY, "PA_VALPRO", S.DATE_COL)


def q_silver_table(spark, d):
    out = fresh_dir(spark, "silver")
    mf.write_silver(_silver(spark, d), out)
    return mf.read_silver(spark, out).select(S.FACILITY, S.PROCEDURE, S.SOURCE_COL, S.DATE_COL, "PA_VALPRO", S.PART_YEAR, S.PART_MONTH)


class _NoGold(mf.Layout):
    """A layout whose gold cannot be written: its folder is a file."""

    @property
    def gold(self) -> str:
        return self._p("not-a-folder")


def q_resume_from_silver(spark, d):
    """Gold fails after silver is stored; the next run has no bronze at all."""
    root = fresh_dir(spark, "resume")
    broken = _NoGold(root)
    write_new(spark, broken.gold, "x")
    bronze = _landed_bronze(spark, d)
    try:
        mf.ingest(spark, bronze, broken, TODAY, start=START, keep_silver=True)
    except Exception:  # noqa: BLE001 - the failure this query is about
        pass
    layout = mf.Layout(root)
    mf.ingest(spark, bronze.where(F.lit(False)), layout, TODAY, start=START, keep_silver=True)
    return _r2(mf.read_gold(spark, layout.gold).select(*S.GOLD_COLUMNS))


def q_gold_tree(spark, d):
    """Months published as ano=YYYY/mes=MM by another tool."""
    out, tree = fresh_dir(spark, "gold"), fresh_dir(spark, "gold-tree")
    mf.write_month_partitions(_gold(spark, d), out)
    for a, m in mf.month_folders(spark, out):
        rename_folder(spark, f"{out}/{S.PART_YEAR}={a}/{S.PART_MONTH}={m}", f"{tree}/ano={a}/mes={m:02d}")
    return _r2(mf.read_gold_tree(spark, tree))


def q_label_csv_dim(spark, d):
    """A Latin-1 label table with accents and leading zeros."""
    out = fresh_dir(spark, "labels")
    TD.facility_labels(spark, d).select(
        F.format_string("%07d", "CNES").alias("CNES"), F.concat("FANTASIA", F.lit(" São José")).alias("FANTASIA")
    ).write.option("header", "true").option("encoding", "ISO-8859-1").csv(out)
    return mf.facility_dimension(mf.read_label_table(spark, out))


def q_records_roundtrip(spark, d):
    out = fresh_dir(spark, "records")
    mf.write_records(mf.monthly_totals(_gold(spark, d)), out)
    return _r2(mf.read_records(spark, out))


def q_option_list(spark, d):
    """The municipalities as the Python list a selection box shows."""
    options = mf.to_list(mf.municipalities(_gold(spark, d)))
    return spark.createDataFrame(list(enumerate(options, start=1)), "ord bigint, opcao string")


def q_result_shape(spark, d):
    monthly = _monthly(spark, d)
    rows, columns = mf.shape(monthly)
    return spark.createDataFrame([(rows, columns, ",".join(monthly.columns))], "n_rows bigint, n_columns bigint, names string")


def q_start_months(spark, d):
    landed = mf.landed_months(_gold(spark, d))
    cases = [("explicit", mf.start_month(landed, explicit=START, after_latest=True)),
             ("after_latest", mf.start_month(landed, after_latest=True)), ("default", mf.start_month(landed))]
    return spark.createDataFrame([(c, a, m) for c, (a, m) in cases], "caso string, ano int, mes int")


def q_consolidated_order(spark, d):
    return _file_positions(spark, _ingested(spark, d)["layout"].consolidated, S.DATE_COL, S.MUNICIPALITY, S.FACILITY, S.PROCEDURE)


def q_consolidated_by_keys(spark, d):
    out = fresh_dir(spark, "by-keys")
    mf.consolidate(spark, _ingested(spark, d)["layout"].gold, out, compression="zstd")
    return _file_positions(spark, out, S.DATE_COL, S.MUNICIPALITY, S.FACILITY, S.PROCEDURE)


def q_consolidated_plain(spark, d):
    """Any Parquet reader finds each month once, also after a forced rebuild."""
    layout = mf.Layout(fresh_dir(spark, "plain"))
    mf.write_month_partitions(_gold(spark, d), layout.gold)
    mf.consolidate(spark, layout.gold, layout.consolidated)
    mf.consolidate(spark, layout.gold, layout.consolidated, force=True)
    return _r2(spark.read.parquet(layout.consolidated))


def q_run_rules(spark, d):
    """Consolidation and dimension refresh of runs in a row over landed gold:
    without a consolidated table, with nothing new, forced, dimensions skipped."""
    first = _ingested(spark, d)["layout"]
    layout = mf.Layout(fresh_dir(spark, "rules"))
    mf.write_month_partitions(mf.read_gold(spark, first.gold).select(*S.GOLD_COLUMNS), layout.gold)
    rows, run = [], lambda **kw: mf.run_monthly(spark, mf.read_bronze(spark, first.bronze), layout, TODAY, start=START,
                                                facility_labels=TD.facility_labels(spark, d), **kw)
    for caso, kw in (("sem consolidado", {}), ("nada novo", {}), ("forcado", {"force_consolidate": True}), ("sem dimensoes", {"skip_dims": True})):
        had = mf.consolidated_exists(spark, layout)
        report = run(**kw)
        rows.append((caso, had, report.succeeded, report.consolidated, report.dims_refreshed))
    return spark.createDataFrame(rows, "caso string, existia boolean, ok int, consolidou boolean, dimensoes boolean")


def q_bronze_tree_gold(spark, d):
    """Landed from a foreign tree, then ingested."""
    tree = mf.read_bronze_tree(spark, _tree(spark, {"all": _landed_bronze(spark, d)}, "tree"))
    layout = mf.Layout(fresh_dir(spark, "from-tree"))
    mf.land_bronze(tree, layout.bronze, rebalance=False)
    mf.ingest(spark, mf.read_bronze(spark, layout.bronze), layout, TODAY, start=START)
    return _r2(mf.read_gold(spark, layout.gold).select(*S.GOLD_COLUMNS))


def _broken_tree(spark: SparkSession, d: str) -> str:
    """March sources lack a measure, May ones store a number, and June ones
    have a second file that is no Parquet file."""
    bronze = _landed_bronze(spark, d)
    month = F.month(source_month_date(S.SOURCE_COL))
    root = _tree(spark, {"good": bronze.where(~month.isin(3, 5)),
                         "lacking": bronze.where(month == 3).drop("PA_VALPRO"),
                         "typed": bronze.where(month == 5).withColumn("PA_QTDPRO", F.col("PA_QTDPRO").cast("bigint"))}, "broken")
    for r in bronze.where(month == 6).select(S.SOURCE_COL).distinct().collect():
        write_new(spark, f"{root}/good/{r[0]}/cut.parquet", "PAR1 not the whole file")
    return root


def q_unreadable_sources(spark, d):
    problems = mf.tree_problems(spark, _broken_tree(spark, d))
    told = F.col("erro").startswith("lacks") | F.col("erro").startswith("not text")
    return problems.select(S.SOURCE_COL, F.when(told, F.col("erro")).otherwise("unreadable").alias("problema")).distinct()


def q_ingest_with_unreadable(spark, d):
    """Months of unreadable sources fail and stay pending; the others land whole."""
    root = _broken_tree(spark, d)
    problems = mf.tree_problems(spark, root)
    layout = mf.Layout(fresh_dir(spark, "unreadable"))
    mf.land_bronze(mf.read_bronze_tree(spark, root, exclude=problems), layout.bronze, rebalance=False)
    report = mf.ingest(spark, mf.read_bronze(spark, layout.bronze), layout, TODAY, start=START, unreadable=problems)
    sums = mf.monthly_sums(mf.read_gold(spark, layout.gold), measures=["PA_VALPRO"])
    log = report.log.where("status <> 'no_data'").withColumn(S.DATE_COL, month_start("ano", "mes"))
    return _r2(log.join(sums, S.DATE_COL, "left").select(S.DATE_COL, "status", "PA_VALPRO"))


def _csv_tree(spark: SparkSession, d: str) -> str:
    """Extracts as CSV, each quarter's under a header of its own: in another
    order; without a column that is not required, with a foreign one between;
    with a column twice; May ones lack a measure, and June ones have a second
    file with a short and a long row."""
    bronze = _landed_bronze(spark, d).select(S.SOURCE_COL, S.FACILITY, S.PROCEDURE, S.MUNICIPALITY, *S.MEASURES, "PA_CMP")
    month, root = F.month(source_month_date(S.SOURCE_COL)), fresh_dir(spark, "csv")
    back = [S.SOURCE_COL, *reversed(bronze.columns[1:])]
    parts = {
        "a": bronze.where(month.isin(1, 2, 3)),
        "b": bronze.where(month.isin(4, 6)).select(*back),
        "c": bronze.where(month.isin(7, 8, 9)).drop("PA_CMP").select(S.SOURCE_COL, "PA_QTDAPR", F.lit("7,5").alias("OUTRA"), S.FACILITY,
                                                                     S.PROCEDURE, S.MUNICIPALITY, "PA_VALAPR", "PA_VALPRO", "PA_QTDPRO"),
        "d": bronze.where(month.isin(10, 11, 12)),
        "e": bronze.where(month == 5).drop("PA_VALAPR"),
    }
    for part, df in parts.items():
        # Written without their header, which is put before each file's rows.
        names = ["PA_QTDPRO" if part == "d" and c == "PA_CMP" else c for c in df.columns if c != S.SOURCE_COL]
        lines = df.select(S.SOURCE_COL, F.to_csv(F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(c for c in df.columns if c != S.SOURCE_COL)])).alias("value"))
        head = lines.select(S.SOURCE_COL).distinct().select(S.SOURCE_COL, F.lit(",".join(names)).alias("value"))
        both = head.withColumn("o", F.lit(0)).unionByName(lines.withColumn("o", F.lit(1)))
        both.repartition(S.SOURCE_COL).sortWithinPartitions(S.SOURCE_COL, "o").drop("o").write.partitionBy(S.SOURCE_COL).text(f"{root}-parts/{part}")
        for (source,) in partition_values(spark, f"{root}-parts/{part}", S.SOURCE_COL):
            rename_folder(spark, f"{root}-parts/{part}/{S.SOURCE_COL}={source}", f"{root}/{part}/{source}")
    for r in bronze.where(month == 6).select(S.SOURCE_COL).distinct().collect():
        write_new(spark, f"{root}/b/{r[0]}/more.csv", ",".join(back[1:]) + "\nx,1\n" + "1," * len(back) + "1\n")
    return root


def q_csv_tree_gold(spark, d):
    """Landed from CSV files under five different headers; the sources that
    cannot be read fail their months."""
    root = _csv_tree(spark, d)
    problems = mf.tree_problems(spark, root, "csv")
    layout = mf.Layout(fresh_dir(spark, "from-csv"))
    mf.land_bronze(mf.read_bronze_tree(spark, root, "csv", exclude=problems), layout.bronze, rebalance=False)
    mf.ingest(spark, mf.read_bronze(spark, layout.bronze), layout, TODAY, start=START, unreadable=problems)
    return _r2(mf.read_gold(spark, layout.gold).select(*S.GOLD_COLUMNS))


def q_csv_problems(spark, d):
    problems = mf.tree_problems(spark, _csv_tree(spark, d), "csv")
    return problems.select(S.SOURCE_COL, F.regexp_replace("erro", ", e.g. .*", "").alias("problema"))


def q_ingest_with_bad_month(spark, d):
    """April extracts of facility 1 hold a quantity that is not a number."""
    april = F.month(source_month_date(S.SOURCE_COL)) == 4
    bronze = _bronze(spark, d).withColumn(
        "PA_QTDPRO", F.when(april & (F.col(S.FACILITY) == "1"), "x").otherwise(F.col("PA_QTDPRO")))
    layout = mf.Layout(fresh_dir(spark, "bad-month"))
    report = mf.ingest(spark, bronze, layout, TODAY, start=START)
    return report.log.select("ano", "mes", "status", "detalhe")


def q_published_months(spark, d):
    """Landed months as the run's bookkeeping sees them: a listing."""
    return mf.existing_months(spark, _ingested(spark, d)["layout"])


def q_ingest_run_summary(spark, d):
    runs = _ingested(spark, d)["runs"]
    parts = [r.summary().select(F.lit(i + 1).cast("int").alias("run"), "status", "n")
             for i, r in enumerate(runs)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_landed_months(spark, d):
    layout = _ingested(spark, d)["layout"]
    return mf.landed_months(mf.read_gold(spark, layout.gold))


def q_consolidated(spark, d):
    layout = _ingested(spark, d)["layout"]
    return _r2(mf.read_consolidated(spark, layout.consolidated))


def q_published_facility_dim(spark, d):
    layout = _ingested(spark, d)["layout"]
    return spark.read.parquet(layout.facility_dim)


def q_stream_gold(spark, d):
    """Gold produced by the file-source stream over the landed bronze."""
    from monthly_facts.streaming import run_stream_once

    layout = _ingested(spark, d)["layout"]
    out = fresh_dir(spark, "stream")
    run_stream_once(spark, layout.bronze, out + "/gold", out + "/checkpoint")
    return _r2(mf.read_gold(spark, out + "/gold").select(*S.GOLD_COLUMNS))


def q_dashboard_monthly(spark, d):
    return _r2(_dashboard(spark, d)["monthly"])


def _dashboard(spark, d):
    """All filters at once, labels of both dimensions among them."""
    fac, proc = _facility_dim(spark, d), _procedure_dim(spark, d)
    return mf.dashboard_tables(
        _gold(spark, d), fac, proc, anos=YEARS, municipios=MUNICIPALITIES,
        facility_labels=fac.where(F.col(D.FACILITY_LABEL).like("%1%")).select(D.FACILITY_LABEL),
        procedure_labels=proc.where(F.col(D.PROCEDURE_LABEL).like("%1%")).select(D.PROCEDURE_LABEL))


def _dashboard_query(name):
    return lambda spark, d: _r2(_dashboard(spark, d)[name])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_rows": q_silver_rows,
    "silver_facilities": q_silver_facilities,
    "gold_rollup": q_gold_rollup,
    "years": q_years,
    "year_bounds": q_year_bounds,
    "months_of_years": q_months_of_years,
    "municipalities": q_municipalities,
    "monthly_totals": q_monthly_totals,
    "monthly_totals_filtered": q_monthly_totals_filtered,
    "monthly_totals_by_codes": q_monthly_totals_by_codes,
    "yearly_totals": q_yearly_totals,
    "monthly_preview": q_monthly_preview,
    "facility_dim": q_facility_dim,
    "procedure_dim": q_procedure_dim,
    "procedure_options": q_procedure_options,
    "totals_by_label": q_totals_by_label,
    "totals_by_facility_label": q_totals_by_facility_label,
    "yearly_long": q_yearly_long,
    "yearly_qty_long": q_yearly_qty_long,
    "monthly_value_long": q_monthly_value_long,
    "monthly_qty_long": q_monthly_qty_long,
    "pooled_mean": q_pooled_mean,
    "pooled_mean_qty": q_pooled_mean_qty,
    "mean_caption": q_mean_caption,
    "pending_months": q_pending_months,
    "pending_months_bounded": q_pending_months_bounded,
    "latest_month": q_latest_month,
    "source_grid": q_source_grid,
    "ingest_gold": q_ingest_gold,
    "filtered_from_gold": q_filtered_from_gold,
    "totals_from_consolidated": q_totals_from_consolidated,
    "dim_records": q_dim_records,
    "bad_names_dropped": q_bad_names_dropped,
    "duplicate_columns": q_duplicate_columns,
    "silver_table": q_silver_table,
    "resume_from_silver": q_resume_from_silver,
    "gold_tree": q_gold_tree,
    "label_csv_dim": q_label_csv_dim,
    "records_roundtrip": q_records_roundtrip,
    "option_list": q_option_list,
    "result_shape": q_result_shape,
    "start_months": q_start_months,
    "consolidated_order": q_consolidated_order,
    "consolidated_by_keys": q_consolidated_by_keys,
    "consolidated_plain": q_consolidated_plain,
    "run_rules": q_run_rules,
    "bronze_tree_gold": q_bronze_tree_gold,
    "csv_tree_gold": q_csv_tree_gold,
    "csv_problems": q_csv_problems,
    "unreadable_sources": q_unreadable_sources,
    "ingest_with_unreadable": q_ingest_with_unreadable,
    "ingest_with_bad_month": q_ingest_with_bad_month,
    "published_months": q_published_months,
    "ingest_run_summary": q_ingest_run_summary,
    "landed_months": q_landed_months,
    "consolidated": q_consolidated,
    "published_facility_dim": q_published_facility_dim,
    "stream_gold": q_stream_gold,
    "dashboard_monthly": q_dashboard_monthly,
    **{f"dashboard_{t}": _dashboard_query(t) for t in (
        "yearly_values", "yearly_quantities", "value_series", "quantity_series", "value_mean", "quantity_mean")},
}


# ------------------------------------------------------------------ oracle

_BASE = """
WITH bronze AS (
  SELECT CAST(l_suppkey AS VARCHAR) PA_CODUNI, CAST(l_partkey AS VARCHAR) PA_PROC_ID,
         CAST(s_nationkey AS VARCHAR) PA_MUNPCN, 'PACE' || strftime(l_shipdate, '%y%m') arquivo_origem,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) PA_VALPRO,
         CASE WHEN l_returnflag='R' THEN '0.00' ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END PA_VALAPR,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) PA_QTDPRO,
         CASE WHEN l_returnflag='R' THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END PA_QTDAPR
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
silver AS (
  SELECT *, CAST(year(data_ref) AS INTEGER) Ano, monthname(data_ref) Mes, substr(arquivo_origem, 3, 2) UF
  FROM (SELECT *, CAST(try_strptime('20' || substr(arquivo_origem, -4, 2) || '-' || right(arquivo_origem, 2), '%Y-%m') AS DATE) data_ref FROM bronze)
  WHERE data_ref IS NOT NULL),
gold AS (
  SELECT PA_CODUNI, Ano, Mes, data_ref, PA_MUNPCN, PA_PROC_ID,
         round(sum(CAST(PA_VALPRO AS DOUBLE)), 2) PA_VALPRO, round(sum(CAST(PA_VALAPR AS DOUBLE)), 2) PA_VALAPR,
         CAST(sum(CAST(PA_QTDPRO AS BIGINT)) AS BIGINT) PA_QTDPRO, CAST(sum(CAST(PA_QTDAPR AS BIGINT)) AS BIGINT) PA_QTDAPR
  FROM silver GROUP BY ALL),
monthly AS (
  SELECT data_ref, round(sum(PA_VALPRO), 2) PA_VALPRO, round(sum(PA_VALAPR), 2) PA_VALAPR,
         CAST(sum(PA_QTDPRO) AS BIGINT) PA_QTDPRO, CAST(sum(PA_QTDAPR) AS BIGINT) PA_QTDAPR
  FROM gold GROUP BY data_ref),
facdim AS (
  SELECT DISTINCT CAST(s_suppkey AS VARCHAR) PA_CODUNI, s_name FANTASIA,
         CAST(s_suppkey AS VARCHAR) || ' - ' || s_name label_estabelecimento FROM supplier),
procdim AS (
  SELECT DISTINCT CAST(p_partkey AS VARCHAR) PA_PROC_ID, p_name IP_DSCR,
         CAST(p_partkey AS VARCHAR) || ' - ' || p_name label_procedimento FROM part)
"""

_PENDING = """
SELECT CAST(m AS DATE) m FROM range(DATE '2095-01-01', DATE '2100-01-01', INTERVAL 1 MONTH) t(m)
WHERE CAST(m AS DATE) NOT IN (SELECT data_ref FROM monthly WHERE month(data_ref) <> 6)
"""

_RUN_SUMMARY = """,
cal AS (SELECT CAST(m AS DATE) m FROM range(DATE '2000-01-01', DATE '2101-12-01', INTERVAL 1 MONTH) t(m)),
landed AS (SELECT data_ref m FROM monthly),
r1 AS (SELECT 1 run, CASE WHEN m IN (SELECT m FROM landed) THEN 'ok' ELSE 'no_data' END status
       FROM cal WHERE m <= DATE '2098-12-01'),
r2 AS (SELECT 2 run, CASE WHEN m IN (SELECT m FROM landed) THEN 'ok' ELSE 'no_data' END status
       FROM cal WHERE m > DATE '2098-12-01' OR m NOT IN (SELECT m FROM landed)),
r3 AS (SELECT 3 run, 'no_data' status FROM cal WHERE m NOT IN (SELECT m FROM landed))
SELECT run, status, count(*) n
FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3) GROUP BY ALL
"""

_DASHBOARD = """,
dash AS (SELECT data_ref, round(sum(PA_VALPRO), 2) PA_VALPRO, round(sum(PA_VALAPR), 2) PA_VALAPR,
                CAST(sum(PA_QTDPRO) AS BIGINT) PA_QTDPRO, CAST(sum(PA_QTDAPR) AS BIGINT) PA_QTDAPR
         FROM gold WHERE Ano IN (2098, 2099) AND PA_MUNPCN IN ('1', '2', '15')
         AND PA_CODUNI IN (SELECT PA_CODUNI FROM facdim WHERE label_estabelecimento LIKE '%1%')
         AND PA_PROC_ID IN (SELECT PA_PROC_ID FROM procdim WHERE label_procedimento LIKE '%1%') GROUP BY data_ref)
"""

_FINAL = {
    "silver_rows": "SELECT " + ", ".join(
        c if c in ("PA_CODUNI", "PA_PROC_ID", "PA_MUNPCN", *S.MEASURES) else f"CAST(NULL AS VARCHAR) {c}"
        for c in S.COLUMNS_OF_INTEREST) + ", arquivo_origem, data_ref, Ano, Mes, UF FROM silver",
    "filtered_from_gold": "SELECT data_ref, round(sum(PA_VALPRO), 2) PA_VALPRO, CAST(sum(PA_QTDPRO) AS BIGINT) PA_QTDPRO "
                          "FROM gold WHERE Ano IN (2098, 2099) AND Mes IN ('January', 'March') "
                          "AND PA_MUNPCN IN ('1', '2', '15') GROUP BY data_ref",
    "totals_from_consolidated": "SELECT *, row_number() OVER (ORDER BY data_ref) ord FROM monthly",
    "dim_records": "SELECT 'facility' dim, PA_CODUNI code, label_estabelecimento \"label\" FROM facdim UNION ALL "
                   "SELECT 'procedure', PA_PROC_ID, label_procedimento FROM procdim",
    "bad_names_dropped": "SELECT PA_CODUNI, arquivo_origem, data_ref, PA_VALPRO FROM silver WHERE PA_VALAPR <> '0.00'",
    "duplicate_columns": "SELECT PA_CODUNI, PA_VALPRO, data_ref FROM silver",
    "silver_table": "SELECT PA_CODUNI, PA_PROC_ID, arquivo_origem, data_ref, PA_VALPRO, CAST(year(data_ref) AS INTEGER) ref_ano, "
                    "CAST(month(data_ref) AS INTEGER) ref_mes FROM silver",
    "resume_from_silver": "SELECT * FROM gold",
    "gold_tree": "SELECT *, CAST(year(data_ref) AS INTEGER) ref_ano, CAST(month(data_ref) AS INTEGER) ref_mes FROM gold",
    "label_csv_dim": "SELECT lpad(PA_CODUNI, 7, '0') PA_CODUNI, FANTASIA || ' São José' FANTASIA, "
                     "lpad(PA_CODUNI, 7, '0') || ' - ' || FANTASIA || ' São José' label_estabelecimento FROM facdim",
    "records_roundtrip": "SELECT * FROM monthly",
    "option_list": "SELECT row_number() OVER (ORDER BY PA_MUNPCN) ord, PA_MUNPCN opcao FROM (SELECT DISTINCT PA_MUNPCN FROM gold)",
    "result_shape": "SELECT count(*) n_rows, CAST(5 AS BIGINT) n_columns, 'data_ref,PA_VALPRO,PA_VALAPR,PA_QTDPRO,PA_QTDAPR' \"names\" FROM monthly",
    "start_months": "SELECT 'explicit' caso, 2000 ano, 1 mes UNION ALL SELECT 'default', 2018, 1 UNION ALL "
                    "SELECT 'after_latest', CAST(year(max(data_ref) + INTERVAL 1 MONTH) AS INTEGER), "
                    "CAST(month(max(data_ref) + INTERVAL 1 MONTH) AS INTEGER) FROM gold",
    "consolidated_order": "SELECT data_ref, PA_MUNPCN, PA_CODUNI, PA_PROC_ID, row_number() OVER "
                          "(ORDER BY data_ref, PA_MUNPCN, PA_CODUNI, PA_PROC_ID) ord FROM gold",
    "consolidated_by_keys": "SELECT data_ref, PA_MUNPCN, PA_CODUNI, PA_PROC_ID, row_number() OVER "
                            "(ORDER BY Ano, month(data_ref), PA_MUNPCN, PA_CODUNI, PA_PROC_ID) ord FROM gold",
    "bronze_tree_gold": "SELECT * FROM gold",
    "consolidated_plain": "SELECT *, CAST(year(data_ref) AS INTEGER) ref_ano, CAST(month(data_ref) AS INTEGER) ref_mes FROM gold",
    "run_rules": "SELECT * FROM (VALUES ('sem consolidado', false, 0, true, true), ('nada novo', true, 0, false, false), "
                 "('forcado', true, 0, true, false), ('sem dimensoes', true, 0, false, false)) t(caso, existia, ok, consolidou, dimensoes)",
    "csv_tree_gold": "SELECT * FROM gold WHERE month(data_ref) NOT IN (5, 6)",
    "csv_problems": "SELECT DISTINCT arquivo_origem, CASE month(data_ref) WHEN 5 THEN 'lacks PA_VALAPR' "
                    "ELSE '2 rows do not fit the header' END problema FROM silver WHERE month(data_ref) IN (5, 6)",
    "unreadable_sources": "SELECT DISTINCT arquivo_origem, CASE month(data_ref) WHEN 3 THEN 'lacks PA_VALPRO' "
                          "WHEN 5 THEN 'not text: PA_QTDPRO (INT64)' ELSE 'unreadable' END problema "
                          "FROM silver WHERE month(data_ref) IN (3, 5, 6)",
    "ingest_with_unreadable": "SELECT data_ref, CASE WHEN month(data_ref) IN (3, 5, 6) THEN 'failed' ELSE 'ok' END status, "
                              "CASE WHEN month(data_ref) NOT IN (3, 5, 6) THEN PA_VALPRO END PA_VALPRO FROM monthly",
    "ingest_with_bad_month": """,
cal AS (SELECT CAST(m AS DATE) m FROM range(DATE '2000-01-01', DATE '2101-12-01', INTERVAL 1 MONTH) t(m)),
bad AS (SELECT data_ref, count(*) n FROM silver WHERE month(data_ref) = 4 AND PA_CODUNI = '1' GROUP BY data_ref)
SELECT CAST(year(m) AS INTEGER) ano, CAST(month(m) AS INTEGER) mes,
       CASE WHEN n IS NOT NULL THEN 'failed' WHEN m IN (SELECT data_ref FROM monthly) THEN 'ok' ELSE 'no_data' END status,
       CASE WHEN n IS NOT NULL THEN 'PA_QTDPRO: ' || n || ' values are not numbers, e.g. ' || chr(39) || 'x' || chr(39)
            WHEN m NOT IN (SELECT data_ref FROM monthly) THEN 'no source rows for this month' END detalhe
FROM cal LEFT JOIN bad ON m = data_ref
""",
    "published_months": "SELECT CAST(year(data_ref) AS INTEGER) ano, CAST(month(data_ref) AS INTEGER) mes FROM monthly",
    "silver_facilities": "SELECT PA_CODUNI, data_ref, PA_VALPRO FROM silver WHERE PA_CODUNI IN ('1','2','3')",
    "gold_rollup": "SELECT * FROM gold",
    "years": "SELECT Ano, row_number() OVER (ORDER BY Ano) ord FROM (SELECT DISTINCT Ano FROM gold)",
    "year_bounds": "SELECT min(Ano) lo, max(Ano) hi FROM gold",
    "months_of_years": "SELECT Mes, row_number() OVER (ORDER BY min(data_ref)) ord FROM gold "
                       "WHERE Ano IN (2098, 2099) GROUP BY Mes",
    "municipalities": "SELECT PA_MUNPCN, row_number() OVER (ORDER BY PA_MUNPCN NULLS LAST) ord "
                      "FROM (SELECT DISTINCT PA_MUNPCN FROM gold)",
    "monthly_totals": "SELECT *, row_number() OVER (ORDER BY data_ref) ord FROM monthly",
    "monthly_totals_filtered": "SELECT data_ref, round(sum(PA_VALPRO), 2) PA_VALPRO, "
                               "CAST(sum(PA_QTDPRO) AS BIGINT) PA_QTDPRO FROM gold "
                               "WHERE Ano IN (2098, 2099) AND Mes IN ('January', 'March') "
                               "AND PA_MUNPCN IN ('1', '2', '15') GROUP BY data_ref",
    "monthly_totals_by_codes": "SELECT data_ref, round(sum(PA_VALAPR), 2) PA_VALAPR, "
                               "CAST(sum(PA_QTDAPR) AS BIGINT) PA_QTDAPR FROM gold "
                               "WHERE PA_CODUNI IN ('1', '2', '3', '10', '11') AND PA_PROC_ID IN "
                               "(SELECT CAST(i AS VARCHAR) FROM range(1, 400, 3) t(i)) GROUP BY data_ref",
    "yearly_totals": "SELECT CAST(year(data_ref) AS INTEGER) Ano, round(sum(PA_VALPRO), 2) PA_VALPRO, "
                     "round(sum(PA_VALAPR), 2) PA_VALAPR, CAST(sum(PA_QTDPRO) AS BIGINT) PA_QTDPRO, "
                     "CAST(sum(PA_QTDAPR) AS BIGINT) PA_QTDAPR FROM monthly GROUP BY 1",
    "monthly_preview": "SELECT * FROM monthly ORDER BY data_ref LIMIT 3",
    "facility_dim": "SELECT * FROM facdim",
    "procedure_dim": "SELECT * FROM procdim",
    "procedure_options": "SELECT label_procedimento, row_number() OVER (ORDER BY label_procedimento) ord FROM procdim",
    "totals_by_label": "SELECT data_ref, round(sum(PA_VALPRO), 2) PA_VALPRO FROM gold WHERE PA_PROC_ID IN "
                       "(SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE CAST(p_partkey AS VARCHAR) "
                       "|| ' - ' || p_name LIKE '1% - cold%') GROUP BY data_ref",
    "totals_by_facility_label": "SELECT data_ref, CAST(sum(PA_QTDPRO) AS BIGINT) PA_QTDPRO FROM gold "
                                "WHERE PA_CODUNI IN (SELECT PA_CODUNI FROM facdim "
                                "WHERE label_estabelecimento LIKE '1%') GROUP BY data_ref",
    "yearly_long": "SELECT *, row_number() OVER (ORDER BY tipo, Ano) ord FROM ("
                   "SELECT CAST(year(data_ref) AS INTEGER) Ano, 'Produzido' tipo, round(sum(PA_VALPRO), 2) valor "
                   "FROM monthly GROUP BY 1 UNION ALL SELECT CAST(year(data_ref) AS INTEGER), 'Aprovado', "
                   "round(sum(PA_VALAPR), 2) FROM monthly GROUP BY 1)",
    "yearly_qty_long": "SELECT CAST(year(data_ref) AS INTEGER) Ano, 'Produzido' tipo, "
                       "CAST(sum(PA_QTDPRO) AS BIGINT) quantidade FROM monthly GROUP BY 1 UNION ALL "
                       "SELECT CAST(year(data_ref) AS INTEGER), 'Aprovado', CAST(sum(PA_QTDAPR) AS BIGINT) "
                       "FROM monthly GROUP BY 1",
    "monthly_value_long": "SELECT *, row_number() OVER (ORDER BY data_ref, tipo) ord FROM ("
                          "SELECT data_ref, 'Produzido' tipo, PA_VALPRO valor FROM monthly UNION ALL "
                          "SELECT data_ref, 'Aprovado', PA_VALAPR FROM monthly)",
    "monthly_qty_long": "SELECT data_ref, 'Produzido' tipo, PA_QTDPRO quantidade FROM monthly UNION ALL "
                        "SELECT data_ref, 'Aprovado', PA_QTDAPR FROM monthly",
    "pooled_mean": "SELECT round(avg(v), 2) media FROM (SELECT PA_VALPRO v FROM monthly UNION ALL "
                   "SELECT PA_VALAPR FROM monthly)",
    "pooled_mean_qty": "SELECT round(avg(v), 2) media FROM (SELECT PA_QTDPRO v FROM monthly UNION ALL "
                       "SELECT PA_QTDAPR FROM monthly)",
    "mean_caption": "SELECT format('{:,.0f}', avg(v)) media_fmt FROM (SELECT PA_VALPRO v FROM monthly "
                    "UNION ALL SELECT PA_VALAPR FROM monthly)",
    "pending_months": _PENDING,
    "pending_months_bounded": "SELECT m FROM (" + _PENDING + ") WHERE m <= DATE '2098-12-01'",
    "latest_month": "SELECT CAST(year(max(data_ref)) AS INTEGER) ano, CAST(month(max(data_ref)) AS INTEGER) mes "
                    "FROM gold",
    "source_grid": "SELECT 'PACE' || lpad(CAST(Ano % 100 AS VARCHAR), 2, '0') || lpad(CAST(m AS VARCHAR), 2, '0') "
                   "|| '.dbc' arquivo FROM (SELECT DISTINCT Ano FROM gold) y, range(1, 13) b(m)",
    "ingest_gold": "SELECT * FROM gold",
    "ingest_run_summary": _RUN_SUMMARY,
    "landed_months": "SELECT CAST(year(data_ref) AS INTEGER) ano, CAST(month(data_ref) AS INTEGER) mes "
                     "FROM monthly",
    "consolidated": "SELECT * FROM gold",
    "published_facility_dim": "SELECT * FROM facdim",
    "stream_gold": "SELECT * FROM gold",
    **{f"dashboard_{name}": _DASHBOARD + final for name, final in {
        "monthly": "SELECT * FROM dash",
        "yearly_values": "SELECT CAST(year(data_ref) AS INTEGER) Ano, 'Produzido' tipo, round(sum(PA_VALPRO), 2) valor FROM dash GROUP BY 1 "
                         "UNION ALL SELECT CAST(year(data_ref) AS INTEGER), 'Aprovado', round(sum(PA_VALAPR), 2) FROM dash GROUP BY 1",
        "yearly_quantities": "SELECT CAST(year(data_ref) AS INTEGER) Ano, 'Produzido' tipo, CAST(sum(PA_QTDPRO) AS BIGINT) quantidade FROM dash "
                             "GROUP BY 1 UNION ALL SELECT CAST(year(data_ref) AS INTEGER), 'Aprovado', CAST(sum(PA_QTDAPR) AS BIGINT) FROM dash GROUP BY 1",
        "value_series": "SELECT data_ref, 'Produzido' tipo, PA_VALPRO valor FROM dash UNION ALL SELECT data_ref, 'Aprovado', PA_VALAPR FROM dash",
        "quantity_series": "SELECT data_ref, 'Produzido' tipo, PA_QTDPRO quantidade FROM dash UNION ALL SELECT data_ref, 'Aprovado', PA_QTDAPR FROM dash",
        "value_mean": "SELECT round(avg(v), 2) media FROM (SELECT PA_VALPRO v FROM dash UNION ALL SELECT PA_VALAPR FROM dash)",
        "quantity_mean": "SELECT round(avg(v), 2) media FROM (SELECT PA_QTDPRO v FROM dash UNION ALL SELECT PA_QTDAPR FROM dash)",
    }.items()},
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly totals of the rollup, on sf0.001."""
    return q_monthly_totals(spark, SMOKE_DIR)


# The corpus operators are optional: without their subpackage (or the pipeline
# module at the top) the other queries work as before. An import error inside
# them is not hidden.
_OPTIONAL = ("monthly_facts.llm", "corpus_pipeline")


def _corpus() -> tuple[dict, dict]:
    try:
        import corpus_pipeline
        from monthly_facts.llm import queries as corpus
    except ModuleNotFoundError as e:
        if e.name is None or not any(e.name == n or e.name.startswith(n + ".") for n in _OPTIONAL):
            raise
        return {}, {}
    found, sql = dict(corpus.QUERIES), dict(corpus.ORACLES)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    # A final part that starts with a comma extends the WITH list.
    return {k: _BASE + v for k, v in _FINAL.items()} | _corpus()[1]

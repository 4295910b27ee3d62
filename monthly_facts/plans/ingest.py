"""The monthly ingest run.

1. Months that should exist (calendar from a start month to today minus the
   publication lag) less the months already landed -> pending. Landed months
   are the gold table's partition folders: a listing, not a scan. Pending
   months that no source names prune to no files, so a run with nothing to do
   reads no table.
2. Bronze rows of the pending months -> silver -> rollup in **one** scan of the
   facts. The bronze filter is on the month parsed from the source name, i.e.
   on the bronze partition column, so only pending sources are read. The rollup
   carries, beside its sums, the number of rows whose measures are not numbers;
   it is persisted (executor disk; a lost part is worked out again), its bad months are looked up in it, and all others are written as
   month partitions with dynamic overwrite, in one job.
3. Bad months are reported ``failed`` with column, count and an example (their
   sources alone are looked at again for that) and stay pending; so do months
   of sources that were reported unreadable. A month is ``ok`` if its partition
   is there afterwards. Any other error (a lost cluster, a full disk) rises to
   the caller; months are then still pending.
4. Consolidation and dimension refresh follow the rules of the run: rebuild
   when absent, when any month landed, or when forced. They are independent
   writes and are submitted concurrently.

Each write is one job with an output committer: a lost executor only
re-runs its tasks, and a failed job leaves the previous months untouched.
The pending-month list comes to the driver; it is bounded by the calendar
(twelve rows per year of history), never by data volume.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts import schema as S
from monthly_facts.functions.months import source_month_date
from monthly_facts.operators import dims as D
from monthly_facts.operators.gold import BAD_ROWS, counted_sums, sums, unparsed
from monthly_facts.operators.incremental import (
    PUBLICATION_LAG_MONTHS,
    available_months,
    months_frame,
    pending_months,
    start_month,
)
from monthly_facts.operators.silver import derive_silver, silver_for_months
from monthly_facts.plans.consolidate import consolidate
from monthly_facts.sources.files import any_match, path_exists
from monthly_facts.sources.tables import (
    Layout,
    in_months,
    month_folders,
    read_silver,
    write_month_partitions,
    write_silver,
    write_table,
)

RUN_LOG_SCHEMA = "ano int, mes int, status string, detalhe string"
OK, NO_DATA, FAILED = "ok", "no_data", "failed"


@dataclass
class RunReport:
    log: DataFrame
    succeeded: int
    failed: int
    consolidated: bool = False
    dims_refreshed: bool = False
    dim_errors: list[str] = field(default_factory=list)

    def summary(self) -> DataFrame:
        """Count of months per status."""
        return self.log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def gold_exists(spark: SparkSession, layout: Layout) -> bool:
    return path_exists(spark, layout.gold)


def existing_months(spark: SparkSession, layout: Layout) -> DataFrame:
    """Months already landed in gold (none when gold does not exist yet)."""
    return months_frame(spark, month_folders(spark, layout.gold))


def consolidated_exists(spark: SparkSession, layout: Layout) -> bool:
    """Month folders, or data files that another tool wrote there."""
    return bool(month_folders(spark, layout.consolidated)) or any_match(spark, layout.consolidated + "/*.parquet")


def plan_months(spark: SparkSession, layout: Layout, today: _dt.date,
                start: tuple[int, int] | None = None, end: tuple[int, int] | None = None,
                after_latest: bool = False, lag: int = PUBLICATION_LAG_MONTHS) -> DataFrame:
    """Pending (ano, mes) for this run, ordered."""
    landed = existing_months(spark, layout)
    first = start_month(landed, start, after_latest)
    return pending_months(available_months(spark, first, today, lag), landed, end)


def bad_measures(silver: DataFrame, round_quantities: bool = False) -> DataFrame:
    """(ano, mes, coluna, n, exemplo): texts in measures that are not numbers,
    counted per month and measure in one aggregation."""
    aggs = []
    for m in S.MEASURES:
        wrong = unparsed(m, round_quantities)
        aggs += [F.count_if(wrong).alias(f"{m}_n"), F.min(F.when(wrong, F.col(m))).alias(f"{m}_x")]
    counts = silver.groupBy(S.DATE_COL).agg(*aggs)
    each = F.array(*[F.struct(F.lit(m).alias("coluna"), F.col(f"{m}_n").alias("n"), F.col(f"{m}_x").alias("exemplo"))
                     for m in S.MEASURES])
    return counts.select(F.year(S.DATE_COL).alias("ano"), F.month(S.DATE_COL).alias("mes"), F.explode(each).alias("e")).select(
        "ano", "mes", "e.*").where("n > 0")


def _stored_silver(spark: SparkSession, layout: Layout, months: list[tuple[int, int]]) -> DataFrame:
    silver = read_silver(spark, layout.silver).where(in_months(months))
    return silver.select([f.name for f in S.SILVER_SCHEMA.fields])


def _unreadable_months(spark: SparkSession, unreadable: DataFrame | None) -> dict[tuple[int, int], str]:
    """Months named by the sources of a report of unreadable files (a row per
    file), with what was said of them."""
    if unreadable is None:
        return {}
    d = source_month_date(S.SOURCE_COL)
    rows = unreadable.select(F.year(d).alias("a"), F.month(d).alias("m"), "arquivo", "erro").where("a IS NOT NULL").collect()
    out: dict[tuple[int, int], list[str]] = {}
    for r in rows:
        out.setdefault((r["a"], r["m"]), []).append(f"{r['arquivo']}: {r['erro']}")
    return {m: "; ".join(sorted(said)) for m, said in out.items()}


def _say_bad(silver: DataFrame, round_quantities: bool, errors: dict[tuple[int, int], str]) -> None:
    for r in bad_measures(silver, round_quantities).orderBy("ano", "mes", "coluna").collect():
        said = f"{r['coluna']}: {r['n']} values are not numbers, e.g. {r['exemplo']!r}"
        m = (r["ano"], r["mes"])
        errors[m] = f"{errors[m]}; {said}" if m in errors else said


def _land(silver: DataFrame, layout: Layout, round_quantities: bool, errors: dict[tuple[int, int], str]) -> None:
    """Roll up and write every month without bad texts, from one scan."""
    # On disk: in memory it would take the room of the sorts that follow.
    counted = counted_sums(silver, round_quantities).persist(StorageLevel.DISK_ONLY)
    try:
        found = counted.groupBy(S.DATE_COL).agg(F.sum(BAD_ROWS).alias("n")).collect()
        bad = [r[S.DATE_COL] for r in found if r["n"]]
        if bad:
            _say_bad(silver.where(F.col(S.DATE_COL).isin(bad)), round_quantities, errors)
        good = counted.where(~F.col(S.DATE_COL).isin(bad)) if bad else counted
        if len(found) > len(bad):
            write_month_partitions(good.drop(BAD_ROWS), layout.gold, names=True)
    finally:
        counted.unpersist()


def _land_through_silver(spark: SparkSession, bronze: DataFrame, layout: Layout, months: list[tuple[int, int]],
                         round_quantities: bool, errors: dict[tuple[int, int], str]) -> None:
    """Months whose silver is stored need no bronze: it was found clean when it
    was written (resume after a failure between silver and gold). Silver of the
    other months is looked through before it is stored."""
    stored = set(month_folders(spark, layout.silver))
    fresh = [m for m in months if m not in stored]
    silver = silver_for_months(derive_silver(bronze), fresh)
    if fresh:
        _say_bad(silver, round_quantities, errors)
        write_silver(silver_for_months(silver, [m for m in fresh if m not in errors]), layout.silver)
    months = [m for m in month_folders(spark, layout.silver) if m in set(months)]
    if months:
        write_month_partitions(sums(_stored_silver(spark, layout, months), round_quantities), layout.gold, names=True)


def ingest(spark: SparkSession, bronze: DataFrame, layout: Layout, today: _dt.date,
           start: tuple[int, int] | None = None, end: tuple[int, int] | None = None,
           after_latest: bool = False, lag: int = PUBLICATION_LAG_MONTHS,
           keep_silver: bool = False, round_quantities: bool = False,
           unreadable: DataFrame | None = None) -> RunReport:
    """Land every pending month from ``bronze`` into ``layout.gold``.

    ``unreadable`` is a report of files that are not in ``bronze`` (rows of
    ``bronze.tree_problems``): their months fail and stay pending."""
    pending = plan_months(spark, layout, today, start, end, after_latest, lag)
    plan = [(r["ano"], r["mes"]) for r in pending.orderBy("ano", "mes").collect()]
    errors = {m: said for m, said in _unreadable_months(spark, unreadable).items() if m in set(plan)}
    months = [m for m in plan if m not in errors]
    if months and keep_silver:
        _land_through_silver(spark, bronze, layout, months, round_quantities, errors)
    elif months:
        _land(silver_for_months(derive_silver(bronze), months), layout, round_quantities, errors)
    landed = set(month_folders(spark, layout.gold))
    rows: list[tuple] = []
    for a, m in plan:
        if (a, m) in errors:
            rows.append((a, m, FAILED, errors[(a, m)]))
        elif (a, m) in landed:
            rows.append((a, m, OK, None))
        else:
            rows.append((a, m, NO_DATA, "no source rows for this month"))
    log = spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    ok = sum(1 for r in rows if r[2] == OK)
    return RunReport(log=log, succeeded=ok, failed=len(rows) - ok)


def _dimension_jobs(layout: Layout, facility_labels: DataFrame | None,
                    procedure_labels: DataFrame | None) -> list[tuple[str, object]]:
    jobs = []
    if facility_labels is not None:
        jobs.append((layout.facility_dim,
                     lambda: write_table(D.facility_dimension(facility_labels), layout.facility_dim)))
    if procedure_labels is not None:
        jobs.append((layout.procedure_dim,
                     lambda: write_table(D.procedure_dimension(procedure_labels), layout.procedure_dim)))
    return jobs


def _run_concurrently(jobs: list[tuple[str, object]]) -> list[str]:
    """Run independent write jobs from separate threads (Spark schedules
    jobs from different threads side by side); returns error messages."""
    errors = []
    if not jobs:
        return errors
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [(name, pool.submit(fn)) for name, fn in jobs]
        for name, fut in futures:
            e = fut.exception()
            if e is not None:
                errors.append(f"{name}: {str(e).strip() or type(e).__name__}")
    return errors


def refresh_dimensions(spark: SparkSession, layout: Layout, facility_labels: DataFrame | None,
                       procedure_labels: DataFrame | None) -> list[str]:
    """Build and publish both dimensions, concurrently; one failing does not
    stop the other. Returns the error messages."""
    return _run_concurrently(_dimension_jobs(layout, facility_labels, procedure_labels))


def run_monthly(spark: SparkSession, bronze: DataFrame, layout: Layout, today: _dt.date,
                start: tuple[int, int] | None = None, end: tuple[int, int] | None = None,
                after_latest: bool = False, facility_labels: DataFrame | None = None,
                procedure_labels: DataFrame | None = None, force_consolidate: bool = False,
                skip_dims: bool = False, keep_silver: bool = False,
                lag: int = PUBLICATION_LAG_MONTHS, round_quantities: bool = False,
                unreadable: DataFrame | None = None) -> RunReport:
    """Ingest pending months, then consolidate and refresh dimensions when
    needed: consolidate if the consolidated table is absent, any month
    landed, or ``force_consolidate``; refresh dimensions (unless skipped) if
    any month landed or the consolidated table was absent."""
    had_consolidated = consolidated_exists(spark, layout)
    report = ingest(spark, bronze, layout, today, start, end, after_latest, lag, keep_silver,
                    round_quantities, unreadable)
    do_consolidate = (not had_consolidated or report.succeeded > 0 or force_consolidate) and gold_exists(spark, layout)
    do_dims = not skip_dims and (report.succeeded > 0 or not had_consolidated)
    jobs = _dimension_jobs(layout, facility_labels, procedure_labels) if do_dims else []
    if do_consolidate:
        landed = [(r["ano"], r["mes"]) for r in report.log.where(F.col("status") == OK).select("ano", "mes").collect()]
        jobs.append((layout.consolidated, lambda: consolidate(
            spark, layout.gold, layout.consolidated, landed, force=force_consolidate)))
    errors = _run_concurrently(jobs)
    cons_errors = [e for e in errors if e.startswith(layout.consolidated + ":")]
    if cons_errors:
        raise RuntimeError(cons_errors[0])
    report.consolidated = do_consolidate
    report.dims_refreshed = do_dims
    report.dim_errors = [e for e in errors if e not in cons_errors]
    return report

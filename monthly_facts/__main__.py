"""Command line for the monthly run.

    spark-submit -m monthly_facts --root s3a://bucket/monthly \\
        [--start 2018-01] [--end 2024-12] [--today 2025-03-10] \\
        [--after-latest] [--facility-labels PATH] [--procedure-labels PATH] \\
        [--labels-format csv|parquet] [--force-consolidate] [--skip-dims] [--keep-silver]
        [--extracts PATH [--extracts-format parquet|csv] [--extracts-sep ,] [--extracts-encoding UTF-8]]
        [--endpoint URL] [--path-style]

Uses the session the cluster provides (``getOrCreate``); the bronze table is
``<root>/bronze``. With ``--extracts``, a tree of one directory per source
file, the sources in it are landed there first; files that cannot be read (CSV
files also for rows that do not fit their header) are reported, their months fail and stay pending. ``--endpoint`` points ``s3a://``
at another object store; credentials come from the session's own
configuration. Prints the run summary and exits non-zero if a month failed.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession

from monthly_facts.plans.ingest import run_monthly
from monthly_facts.sources.bronze import land_bronze, read_bronze, read_bronze_tree, tree_problems
from monthly_facts.sources.tables import Layout, configure_object_store, read_label_table


def _month(text: str) -> tuple[int, int]:
    y, m = text.split("-")
    return int(y), int(m)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="monthly_facts", description="Ingest pending months.")
    p.add_argument("--root", required=True)
    p.add_argument("--start", type=_month, default=None, help="YYYY-MM")
    p.add_argument("--end", type=_month, default=None, help="YYYY-MM")
    p.add_argument("--today", type=_dt.date.fromisoformat, default=_dt.date.today())
    p.add_argument("--after-latest", action="store_true")
    p.add_argument("--facility-labels", default=None)
    p.add_argument("--procedure-labels", default=None)
    p.add_argument("--labels-format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--force-consolidate", action="store_true")
    p.add_argument("--skip-dims", action="store_true")
    p.add_argument("--keep-silver", action="store_true")
    p.add_argument("--extracts", default=None, help="tree of decoded extracts to land first")
    p.add_argument("--extracts-format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--extracts-sep", default=",", help="field separator of CSV extracts")
    p.add_argument("--extracts-encoding", default="UTF-8", help="encoding of CSV extracts")
    p.add_argument("--endpoint", default=None, help="object-store endpoint for s3a:// paths")
    p.add_argument("--path-style", action="store_true", help="path-style object-store access")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("monthly-facts").getOrCreate()
    if a.endpoint:
        configure_object_store(spark, a.endpoint, path_style=a.path_style)
    layout = Layout(a.root)
    unreadable = None
    if a.extracts:
        options = {"sep": a.extracts_sep, "encoding": a.extracts_encoding} if a.extracts_format == "csv" else {}
        unreadable = tree_problems(spark, a.extracts, a.extracts_format, **options)
        tree = read_bronze_tree(spark, a.extracts, a.extracts_format, exclude=unreadable, **options)
        land_bronze(tree, layout.bronze, rebalance=False)
    fac = read_label_table(spark, a.facility_labels, a.labels_format) if a.facility_labels else None
    proc = read_label_table(spark, a.procedure_labels, a.labels_format) if a.procedure_labels else None
    report = run_monthly(spark, read_bronze(spark, layout.bronze), layout, a.today, start=a.start,
                         end=a.end, after_latest=a.after_latest, facility_labels=fac,
                         procedure_labels=proc, force_consolidate=a.force_consolidate,
                         skip_dims=a.skip_dims, keep_silver=a.keep_silver, unreadable=unreadable)
    report.summary().show()
    print(f"landed={report.succeeded} not_landed={report.failed} "
          f"consolidated={report.consolidated} dims={report.dims_refreshed}")
    failed = report.log.where("status = 'failed'").count()
    return 1 if failed or report.dim_errors else 0


if __name__ == "__main__":
    sys.exit(main())

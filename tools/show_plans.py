"""Print the formatted physical plans of the headline jobs.

Usage: python tools/show_plans.py [sf_dir]

Lands the test tables into a fresh folder under the session's shared
scratch folder, then explains: the gold landing job for all months, the
filtered monthly totals served from gold, the landed-months scan, and the
consolidation sort. Look for PartitionFilters / PushedFilters / ReadSchema
on the scans and for the exchanges between aggregates.
"""
import datetime as dt
import sys

sys.path.insert(0, ".")
import monthly_facts as mf  # noqa: E402
from monthly_facts import schema as S  # noqa: E402
from monthly_facts.operators.gold import with_month_partition  # noqa: E402
from monthly_facts.session import build_session, fresh_dir  # noqa: E402
from monthly_facts.sources import testdata as TD  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    layout = mf.Layout(fresh_dir(spark, "plans"))
    mf.land_bronze(TD.bronze_from_tables(spark, sf_dir), layout.bronze)
    bronze = mf.read_bronze(spark, layout.bronze)
    mf.run_monthly(spark, bronze, layout, dt.date(2102, 1, 15), start=(2000, 1))
    months = [(r.ano, r.mes) for r in mf.source_months(bronze).collect()][:2]

    print("=== landing two months: silver -> rollup -> month partitions")
    g = mf.rollup(mf.silver_for_months(mf.derive_silver(bronze), months))
    (with_month_partition(g).hint("rebalance", S.PART_YEAR, S.PART_MONTH)
     .sortWithinPartitions(S.PART_YEAR, S.PART_MONTH, S.MUNICIPALITY, S.FACILITY, S.PROCEDURE)
     .explain("formatted"))
    gold = mf.read_gold(spark, layout.gold)
    print("=== filtered monthly totals served from gold")
    mf.monthly_totals(gold, anos=[2098], meses=["March"], municipios=["1", "2"]).explain("formatted")
    print("=== landed months")
    mf.landed_months(gold).explain("formatted")
    print("=== consolidation order")
    gold.select(*S.GOLD_COLUMNS).orderBy(S.DATE_COL, S.MUNICIPALITY, S.FACILITY, S.PROCEDURE).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

"""The consolidated table: all gold months as one ordered table.

It is a plain Parquet table, partitioned by month and sorted inside a month by
municipality, facility and procedure: in the order of its month folders, then of
the file names, its rows are ordered by date and by year, month and those keys
alike, and ``spark.read.parquet`` reads it whole. Dynamic partition overwrite
replaces the months that are written when the job commits, so a run that fails
leaves the old table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from monthly_facts import schema as S
from monthly_facts.sources.tables import in_months, month_folders, read_gold

MONTH_ORDER = [S.MUNICIPALITY, S.FACILITY, S.PROCEDURE]


def consolidate(spark: SparkSession, gold_path: str, out_path: str, months: Iterable[tuple[int, int]] = (),
                compression: str = "snappy", force: bool = False) -> list[tuple[int, int]]:
    """Bring the consolidated table up to gold; returns the months written:
    those that it lacks and those named in ``months`` (which gold has written
    again). With ``force`` the whole table is written anew, and months that
    gold has no longer are gone.

    The sort is a range shuffle with sampled bounds; the secondary keys let a
    month that holds a third of all rows spread over many tasks, whose files
    follow one another in the month's order.
    """
    landed = month_folders(spark, gold_path)
    present = set() if force else set(month_folders(spark, out_path))
    wanted = [m for m in landed if m not in present or m in set(months)]
    if not wanted:
        return []
    keys = [S.PART_YEAR, S.PART_MONTH]
    gold = read_gold(spark, gold_path)
    if len(wanted) < len(landed):
        gold = gold.where(in_months(wanted))
    ordered = gold.repartitionByRange(*keys, *MONTH_ORDER).sortWithinPartitions(*keys, *MONTH_ORDER)
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if force else "dynamic")
        .option("compression", compression)
        .partitionBy(*keys)
        .parquet(out_path)
    )
    return wanted

"""Readers and writers for the silver, gold, consolidated and dimension tables.

Layout under one root (any Hadoop path, e.g. ``s3a://bucket/prefix``)::

    silver/ref_ano=YYYY/ref_mes=M/      silver, partitioned by month
    gold/ref_ano=YYYY/ref_mes=M/        monthly rollup, partitioned by month
    consolidated/ref_ano=YYYY/ref_mes=M/  all months, in order (plans/consolidate.py)
    dims/facility/  dims/procedure/     labelled dimensions

Month partitions are written with dynamic overwrite, so a run replaces exactly
the months it computed. Consolidated lives outside ``gold/`` so partition
discovery of gold never sees it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthly_facts import schema as S
from monthly_facts.functions.months import partition_value
from monthly_facts.operators.gold import with_month_names, with_month_partition
from monthly_facts.sources.files import make_folder, partition_values, path_exists


@dataclass(frozen=True)
class Layout:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def gold(self) -> str:
        return self._p("gold")

    @property
    def consolidated(self) -> str:
        return self._p("consolidated")

    @property
    def facility_dim(self) -> str:
        return self._p("dims", "facility")

    @property
    def procedure_dim(self) -> str:
        return self._p("dims", "procedure")


# -------------------------------------------------------------- object store

def configure_object_store(spark: SparkSession, endpoint: str, access_key: str | None = None,
                           secret_key: str | None = None, path_style: bool = True) -> None:
    """Point the ``s3a://`` connector at an S3-compatible endpoint.

    Paths stay plain strings; only session settings change. Credentials are
    taken from the arguments here, never from the code.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint", endpoint)
    conf.set("fs.s3a.path.style.access", "true" if path_style else "false")
    if access_key is not None:
        conf.set("fs.s3a.access.key", access_key)
    if secret_key is not None:
        conf.set("fs.s3a.secret.key", secret_key)


# --------------------------------------------------------------------- reads

def _partitioned(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(c, T.IntegerType()) for c in (S.PART_YEAR, S.PART_MONTH)])


def month_folders(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(year, month) of the month partitions of a silver or gold table, from
    its folders: no file is opened."""
    return sorted((int(a), int(m)) for a, m in partition_values(spark, path, S.PART_YEAR, S.PART_MONTH)
                  if a.isdigit() and m.isdigit())


def in_months(months: list[tuple[int, int]]) -> Column:
    """Whether a row's month partition is one of ``months``: prunes folders."""
    listed = ", ".join(str(a * 100 + m) for a, m in months) or "NULL"
    return F.expr(f"{S.PART_YEAR} * 100 + {S.PART_MONTH} IN ({listed})")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver written by ``write_silver``: the 31 silver columns plus the
    partition columns ``ref_ano`` / ``ref_mes`` (used for pruning)."""
    return spark.read.schema(_partitioned(S.SILVER_SCHEMA)).parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold written by ``write_month_partitions``: the ten gold columns plus
    the partition columns ``ref_ano`` / ``ref_mes`` (used for pruning)."""
    return spark.read.schema(_partitioned(S.GOLD_SCHEMA)).parquet(path)


def read_gold_tree(spark: SparkSession, path: str) -> DataFrame:
    """Gold published as ``ano=YYYY/mes=MM/<file>.parquet`` by another tool.

    Partition inference is disabled (a path column ``mes`` would replace the
    month-name column ``Mes``); the month is parsed from each file's path.
    Columns are cast to the gold schema (quantity sums written as DOUBLE
    come back as bigint).
    """
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    fp = F.col("_metadata.file_path")
    return S.align(df, S.GOLD_SCHEMA).select(
        *S.GOLD_COLUMNS,
        partition_value(fp, "ano").alias(S.PART_YEAR),
        partition_value(fp, "mes").alias(S.PART_MONTH),
    )


def read_consolidated(spark: SparkSession, path: str) -> DataFrame:
    """The ten gold columns of the consolidated table; where another tool wrote
    it, of a plain directory or single file cast to the gold schema."""
    if month_folders(spark, path):
        return spark.read.schema(_partitioned(S.GOLD_SCHEMA)).parquet(path).select(*S.GOLD_COLUMNS)
    return S.align(spark.read.parquet(path), S.GOLD_SCHEMA)


def migrate_gold_tree(spark: SparkSession, tree_path: str, gold_path: str) -> None:
    """Copy a month tree ``ano=YYYY/mes=MM/`` into this library's gold layout
    (one job; months are taken from the file paths)."""
    tree = read_gold_tree(spark, tree_path)
    write_month_partitions(tree.select(*S.GOLD_COLUMNS), gold_path)


def read_dimension(spark: SparkSession, path: str, key: str, label: str) -> DataFrame:
    """Code and label columns of a published dimension."""
    return spark.read.parquet(path).select(key, label)


def read_label_table(spark: SparkSession, path: str, fmt: str = "csv",
                     encoding: str = "ISO-8859-1", **options) -> DataFrame:
    """A code/name label table, as decoded CSV (Latin-1 by default) or Parquet.

    Every column is read as text so codes keep their leading zeros.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = (spark.read.format(fmt).option("header", "true").option("encoding", encoding)
              .option("inferSchema", "false"))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Temp views over the published tables, for queries written as SQL:
    ``gold`` (with ``ref_ano``/``ref_mes`` for pruning), ``consolidated``,
    ``dim_facility`` and ``dim_procedure``. Only tables that exist are
    registered; returns their names."""
    readers = {
        "gold": (layout.gold, lambda p: read_gold(spark, p)),
        "consolidated": (layout.consolidated, lambda p: read_consolidated(spark, p)),
        "dim_facility": (layout.facility_dim, lambda p: spark.read.parquet(p)),
        "dim_procedure": (layout.procedure_dim, lambda p: spark.read.parquet(p)),
    }
    names = []
    for name, (path, read) in readers.items():
        if path_exists(spark, path):
            read(path).createOrReplaceTempView(name)
            names.append(name)
    return names


# -------------------------------------------------------------------- writes

def write_month_partitions(df: DataFrame, path: str, sort_keys: list[str] | None = None,
                           compression: str = "snappy", rebalance: bool = True,
                           names: bool = False) -> None:
    """Write rows with ``data_ref`` into ``ref_ano=/ref_mes=`` partitions,
    replacing only the months present in ``df``.

    ``rebalance`` on the month columns gives each task one month's rows and
    lets adaptive execution split a month that is much larger than the rest,
    so file count tracks data volume instead of tasks x months. Rows are
    sorted within each file so Parquet min/max statistics skip row groups for
    municipality / facility / procedure filters.

    ``rebalance=False`` skips that shuffle for inputs whose tasks already hold
    one month each (silver read from a bronze landed per source file).

    With ``names`` the rows are sums that lack ``Ano`` and ``Mes``, which are
    added behind the shuffle and the sort. A path that cannot be a folder fails
    at once, before anything is computed.
    """
    keys = sort_keys if sort_keys is not None else [S.MUNICIPALITY, S.FACILITY, S.PROCEDURE]
    out = with_month_partition(df)
    if rebalance:
        out = out.hint("rebalance", S.PART_YEAR, S.PART_MONTH)
    if keys:
        out = out.sortWithinPartitions(S.PART_YEAR, S.PART_MONTH, *keys)
    if names:
        out = with_month_names(out, S.PART_YEAR, S.PART_MONTH)
    make_folder(df.sparkSession, path)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(S.PART_YEAR, S.PART_MONTH)
        .parquet(path)
    )


def write_silver(silver: DataFrame, path: str, rebalance: bool = False) -> None:
    """Silver as a month-partitioned Parquet table (snappy, dictionary pages).

    Silver derived from a bronze landed per source file already has one month
    per task, so no shuffle is added unless ``rebalance`` is asked for (input
    whose tasks mix many months).
    """
    write_month_partitions(silver, path, sort_keys=[], rebalance=rebalance)


def write_table(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Overwrite a whole (unpartitioned) table."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)

"""Bronze: decoded source extracts, one directory per source file.

Two shapes are read:

* a **landed** table written by ``land_bronze``, partitioned by
  ``arquivo_origem`` (``<root>/arquivo_origem=PACE2401/part-*.parquet``).
  Partition discovery supplies the source name, and filters on the month
  derived from it prune whole directories;
* a **foreign tree** ``<root>/PACE2401/*.parquet`` (one directory per source
  file, any depth). The source name is the parent directory of each file,
  taken from the ``_metadata.file_path`` column.

Bronze is text in both: an explicit schema is read, never one that is inferred
from whichever file comes first. Nothing is left out silently: a file that
cannot be read, that lacks a key or measure column, stores one as anything
but text or (CSV) has rows that do not fit its header is an error, unless its
source is named in ``exclude``, which ``tree_problems`` can supply and the
ingest run reports as failed. Footers and headers are looked up in tasks
(``sources/survey.py``).

Decoding the original compressed extract format is not done here: extracts
arrive as Parquet or CSV.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthly_facts import schema as S
from monthly_facts.sources.files import partition_values
from monthly_facts.sources.survey import REQUIRED, survey

PROBLEMS_SCHEMA = "arquivo string, arquivo_origem string, erro string"
# Files named in an error message.
TOLD = 20
_BAD = "__bad_row"


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Read a bronze table landed by ``land_bronze``."""
    return (
        spark.read.option("basePath", path)
        .schema(landed_schema())
        .parquet(path)
    )


def landed_schema():
    """Columns of interest (text) plus the source-name partition column."""
    return T.StructType(list(S.BRONZE_SCHEMA.fields) + [T.StructField(S.SOURCE_COL, T.StringType(), True)])


def landed_sources(spark: SparkSession, path: str) -> list[str]:
    """Source names of a landed bronze table, from its partition folders."""
    return [v for (v,) in partition_values(spark, path, S.SOURCE_COL)]


def tree_problems(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None, **options) -> DataFrame:
    """(arquivo, arquivo_origem, erro) of the files of a tree that cannot be
    read as bronze: found in the Parquet footers or CSV headers, and for CSV in
    one scan that counts the rows with more or fewer fields than the header."""
    found = survey(spark, path, fmt, columns, **options)
    rows = found.where("erro IS NOT NULL").select("arquivo", "arquivo_origem", "erro").collect()
    if fmt == "csv":
        each = [_csv_rows(spark, files, names, "PERMISSIVE", options).where(f"{_BAD} IS NOT NULL")
                for names, files in _layouts(found.where("erro IS NULL"))]
        for bad in each:
            # Spark refuses queries that look at nothing but the bad rows' column.
            counted = bad.groupBy("arquivo").agg(F.count(F.lit(1)).alias("n"), F.min(_BAD).alias("x"), F.count("c0")).collect()
            rows += [(r["arquivo"], _source_of(r["arquivo"]), f"{r['n']} rows do not fit the header, e.g. {r['x'][:200]!r}") for r in counted]
    return spark.createDataFrame(sorted(map(tuple, rows)), PROBLEMS_SCHEMA)


def _source_of(path: str) -> str:
    return path.rsplit("/", 2)[-2]


def _layouts(found: DataFrame) -> list[tuple[list[str], list[str]]]:
    """(columns in order, files) per different header: as many rows as there
    are headers. The files' names go back into Spark's reader."""
    rows = found.where("colunas IS NOT NULL").groupBy("colunas").agg(F.collect_list("arquivo").alias("files")).collect()
    return sorted((r["colunas"], sorted(r["files"])) for r in rows)


def _csv_rows(spark: SparkSession, files: list[str], names: list[str], mode: str, options: dict) -> DataFrame:
    """Rows of CSV files that share a header, their fields by place, as text:
    of columns that share a name the first stays. All fields of a row are
    counted, whatever columns are asked for."""
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
    reader = spark.read.options(**options).option("header", "true").option("enforceSchema", "true").option("mode", mode).option(
        "columnPruning", "false").option("ignoreCorruptFiles", "false")
    if mode == "PERMISSIVE":
        fields.append(T.StructField(_BAD, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", _BAD)
    df = reader.schema(T.StructType(fields)).csv(files)
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in names[:i] and n in S.COLUMNS_OF_INTEREST]
    return df.select(*(["c0", _BAD] if mode == "PERMISSIVE" else kept), F.col("_metadata.file_path").alias("arquivo"))


def read_bronze_tree(spark: SparkSession, path: str, fmt: str = "parquet",
                     columns: list[str] | None = None, exclude: Iterable[str] | DataFrame = (),
                     **options) -> DataFrame:
    """Read a tree of one directory per source file, any nesting, as text.

    Partition inference is off (``recursiveFileLookup``), the source name is
    the file's parent directory. CSV files are read under their own headers:
    one scan per different header, fields by their place in it. A problem in
    any file's footer or header (see ``tree_problems``) raises, a CSV row with
    more or fewer fields than its header fails the job that reads it; the
    sources in ``exclude`` (names, or the rows of ``tree_problems``) are not
    read. A column of interest that is not required reads as NULL where a file
    lacks it.
    """
    cols = columns if columns is not None else S.COLUMNS_OF_INTEREST
    if isinstance(exclude, DataFrame):
        exclude = [r[0] for r in exclude.select(S.SOURCE_COL).distinct().collect()]
    exclude = sorted(set(exclude))
    found = survey(spark, path, fmt, cols, **options)
    if exclude:
        found = found.where(~F.col("arquivo_origem").isin(exclude))
    bad = found.where("erro IS NOT NULL").orderBy("arquivo").limit(TOLD + 1).collect()
    if bad:
        raise ValueError("cannot read as bronze: " + "; ".join(f"{r['arquivo']}: {r['erro']}" for r in bad[:TOLD])
                         + ("; and more" if len(bad) > TOLD else ""))
    source = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    if fmt == "parquet":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        reader = spark.read.options(**options).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "false")
        df = reader.schema(schema).parquet(path)
        # The planner drops the files of excluded sources before any is opened.
        df = df.where(~source.isin(exclude)) if exclude else df
        return df.select(*cols, source.alias(S.SOURCE_COL))
    out = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*cols, S.SOURCE_COL]]))
    for names, files in _layouts(found):
        df = _csv_rows(spark, files, names, "FAILFAST", options)
        source = F.element_at(F.split("arquivo", "/"), -2)
        out = out.unionByName(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in cols],
                                        source.alias(S.SOURCE_COL)))
    return out


def land_bronze(extracts: DataFrame, path: str, mode: str = "overwrite",
                rebalance: bool = True) -> None:
    """Write decoded extracts (which carry ``arquivo_origem``) as a bronze
    table of text columns, partitioned by source name. A missing key or
    measure column is an error; other columns of interest that the extracts
    lack are landed as NULL.

    Overwrite is dynamic: only the source names present in ``extracts`` are
    replaced, so landing one month never touches the others. By default rows
    are rebalanced on the source name first, so each task writes one source
    and adaptive execution splits an oversized source across several tasks;
    without it every task would write a file into every source it touches.
    Pass ``rebalance=False`` when each input file already holds one source
    (e.g. ``read_bronze_tree``), which saves a full shuffle of the extracts.
    """
    missing = [c for c in [S.SOURCE_COL, *REQUIRED] if c not in extracts.columns]
    if missing:
        raise ValueError(f"extracts lack columns {missing}")
    out = extracts.hint("rebalance", S.SOURCE_COL) if rebalance else extracts
    # Columns that are NULL throughout are added behind the shuffle and the
    # writer's sort: neither carries them.
    out = out.sortWithinPartitions(S.SOURCE_COL).select(
        *[(F.col(c) if c in extracts.columns else F.lit(None)).cast("string").alias(c) for c in S.COLUMNS_OF_INTEREST],
        S.SOURCE_COL)
    (
        out
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(S.SOURCE_COL)
        .parquet(path)
    )

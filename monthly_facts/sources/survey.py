"""What the files of an extract tree hold, looked up in tasks.

The list of files is a DataFrame (Spark lists them, nothing is read of them);
tasks open each one for its Parquet footer or its CSV header only. The driver
makes no call per file and gets back what the caller collects, such as the
problems.

Tasks open files through pyarrow's filesystems, at the place that the store
resolves the root to (mount points of the cluster's own name space included).
For ``s3a://`` roots the endpoint and the keys of the session's configuration
are used.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts import schema as S

# Columns without which a source cannot be rolled up.
REQUIRED = [S.FACILITY, S.MUNICIPALITY, S.PROCEDURE, *S.MEASURES]
SURVEY_SCHEMA = "arquivo string, arquivo_origem string, colunas array<string>, erro string"
# Bytes of a CSV file that hold its header, at most.
HEADER_BYTES = 1 << 20


def tree_files(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo) of all data files below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("arquivo"))


def _store(spark: SparkSession, path: str) -> dict:
    """How tasks reach the files below ``path``: the prefix of listed files,
    what it stands for, and the store's settings."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = p.getFileSystem(conf)
    keys = ("endpoint", "access.key", "secret.key", "path.style.access", "connection.ssl.enabled")
    return {"listed": fs.makeQualified(p).toString().rstrip("/"), "at": fs.resolvePath(p).toString().rstrip("/"),
            "s3": {k: conf.get(f"fs.s3a.{k}") for k in keys}}


def _opener(store: dict):
    """``open(listed file)`` for random access, in a task."""
    from pyarrow import fs as pafs

    scheme, _, rest = store["at"].partition(":")
    if scheme == "file":
        system, at = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    elif scheme in ("s3", "s3a", "s3n"):
        s3 = store["s3"]
        options = {"endpoint_override": s3["endpoint"], "access_key": s3["access.key"], "secret_key": s3["secret.key"],
                   "scheme": "http" if s3["connection.ssl.enabled"] == "false" else None}
        system, at = pafs.S3FileSystem(**{k: v for k, v in options.items() if v}), rest.lstrip("/")
    else:
        system, at = pafs.FileSystem.from_uri(store["at"])

    def place(listed: str) -> str:
        if not listed.startswith(store["listed"]):
            raise ValueError(f"{listed} does not lie below {store['listed']}")
        return at + listed[len(store["listed"]):]

    return lambda listed: system.open_input_file(place(listed)), lambda listed: system.open_input_stream(place(listed), compression="detect")


def _parquet_columns(file) -> dict[str, str]:
    """Top-level columns of a Parquet file: name -> physical type (a text
    column is ``BINARY``)."""
    import pyarrow.parquet as pq

    schema = pq.ParquetFile(file).metadata.schema
    out = {}
    for i in range(len(schema)):
        leaf = schema.column(i)
        name, _, inner = leaf.path.partition(".")
        out[name] = "GROUP" if inner else leaf.physical_type.replace("BYTE_ARRAY", "BINARY") if leaf.physical_type == "BYTE_ARRAY" else leaf.physical_type
    return out


def _csv_columns(stream, encoding: str, options: dict) -> list[str] | None:
    """Names in the first line of a CSV file; None if it has no byte."""
    held = b""
    while b"\n" not in held and len(held) < HEADER_BYTES:
        more = stream.read(1 << 16)
        if not more:
            break
        held += more
    if not held:
        return None
    line = held.split(b"\n", 1)[0].decode(encoding).removeprefix("\ufeff").rstrip("\r")
    return next(csv.reader([line], delimiter=options.get("sep") or options.get("delimiter") or ",", quotechar=options.get("quote") or '"'))


def _problem(columns: list[str], types: dict[str, str], wanted: list[str]) -> str | None:
    missing = [c for c in REQUIRED if c in wanted and c not in columns]
    typed = [f"{c} ({types[c]})" for c in wanted if c in types and types[c] != "BINARY"]
    parts = (["lacks " + ", ".join(missing)] if missing else []) + (["not text: " + ", ".join(typed)] if typed else [])
    return "; ".join(parts) or None


def survey(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None, **options) -> DataFrame:
    """(arquivo, arquivo_origem, colunas, erro) of every file below ``path``:
    its columns in their order and what keeps it from being read as bronze.
    A CSV file without a byte holds no rows: no columns and no problem."""
    if fmt not in ("parquet", "csv"):
        raise ValueError("extracts are parquet or csv")
    wanted, store = columns or S.COLUMNS_OF_INTEREST, _store(spark, path)
    encoding = options.get("encoding") or options.get("charset") or "UTF-8"

    def row(file: str, openers) -> tuple:
        source = file.rsplit("/", 2)[-2]
        try:
            if fmt == "parquet":
                with openers[0](file) as f:
                    types = _parquet_columns(f)
                return file, source, list(types), _problem(list(types), types, wanted)
            with openers[1](file) as f:
                names = _csv_columns(f, encoding, options)
            return file, source, names, names and _problem(names, {}, wanted)
        except Exception as e:  # noqa: BLE001 - told per file
            return file, source, None, f"unreadable: {str(e) or type(e).__name__}"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        openers = _opener(store)
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
        for batch in batches:
            rows = [row(f, openers) for f in batch.column(0).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)],
                                                 names=["arquivo", "arquivo_origem", "colunas", "erro"])

    return tree_files(spark, path).mapInArrow(look, SURVEY_SCHEMA)

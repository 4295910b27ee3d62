"""Folder listings through the session's Hadoop filesystem.

What is listed here is bounded by sources and calendar (partition folders); no
table is scanned for it.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the session's Hadoop filesystem."""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def rename_folder(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _fs(spark, old)
    q, _ = _fs(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise RuntimeError(f"could not rename {old}")


def partition_values(spark: SparkSession, root: str, *keys: str) -> list[tuple[str, ...]]:
    """Values of the partition folders ``key1=.../key2=...`` under ``root``,
    one tuple per folder; empty if there are none."""
    p, fs = _fs(spark, root.rstrip("/") + "".join(f"/{k}=*" for k in keys))
    found = fs.globStatus(p)
    pattern = re.compile("/".join(rf"{re.escape(k)}=([^/]*)" for k in keys) + "$")
    out = []
    for status in found or ():
        m = pattern.search(status.getPath().toString())
        if m and status.isDirectory():
            out.append(tuple(unquote(v) for v in m.groups()))
    return sorted(out)


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether some path matches a glob pattern."""
    p, fs = _fs(spark, pattern)
    return bool(fs.globStatus(p))


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name, then give it its name, which
    must be new: readers see the whole file or none."""
    p, fs = _fs(spark, path)
    aside, _ = _fs(spark, re.sub(r"([^/]+)$", r".\1.tmp", path))
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p) or not fs.rename(aside, p):
        raise RuntimeError(f"{path} exists already or could not be written")

"""Session helpers.

The library never hard-codes cluster sizing; ``build_session`` is for tests,
the benchmark and local use. On a cluster, pass your own session: set
``spark.sql.shuffle.partitions`` to the data size (AQE coalesces small
partitions and splits skewed ones at run time) and point
``spark.checkpoint.dir`` at a shared folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "monthly-facts", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    if master.startswith("local") and "spark.checkpoint.dir" not in conf:
        # One machine: any of its folders is shared by driver and executors.
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="monthly-facts-")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a folder of this machine is
    registered only if the master is local; on a cluster that would scatter
    work tables over the executors' own disks, so it is an error.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local($|\[)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="monthly-facts-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def fresh_dir(spark: SparkSession, name: str = "work") -> str:
    """A new, unique folder under the shared scratch folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "shared_dir", "fresh_dir"]

"""Incremental ingest driven by a file-source stream.

The stream watches the landed bronze table; its checkpoint remembers which
source files were already seen, which is exactly the "what is new since the
last run" bookkeeping of the monthly job. ``trigger(availableNow=True)``
processes everything that arrived and stops, so a scheduler can run it once
a month like the batch job.

A micro-batch only notes which months received new files, as a small folder
``touched/batch=N`` beside the checkpoint. After the drain each noted month
is recomputed once, from *all* its bronze rows, and written with dynamic
partition overwrite; then the note is marked as done. That makes it
idempotent: a replayed batch notes the same months again, months noted before
a failure are refreshed by the next drain, and a late file for a month that
already landed updates that month instead of being ignored or double counted.
With ``processing_time`` there is no end to wait for, so every batch is
followed by a refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthly_facts import schema as S
from monthly_facts.functions.months import source_month_date
from monthly_facts.operators.gold import sums
from monthly_facts.operators.incremental import months_frame
from monthly_facts.operators.silver import derive_silver, silver_for_months
from monthly_facts.sources.bronze import landed_schema, read_bronze
from monthly_facts.sources.files import make_folder, partition_values
from monthly_facts.sources.tables import write_month_partitions


def months_in(batch: DataFrame) -> list[tuple[int, int]]:
    """Distinct (year, month) named by the source files of a batch.

    Only the source-name column is read, and the result is bounded by the
    calendar, so it is safe to bring to the driver.
    """
    d = source_month_date(S.SOURCE_COL)
    rows = (batch.select(d.alias("d")).where(F.col("d").isNotNull())
            .select(F.year("d").alias("a"), F.month("d").alias("m")).distinct().collect())
    return sorted((r["a"], r["m"]) for r in rows)


def refresh_months(spark: SparkSession, bronze_path: str, gold_path: str,
                   months: list[tuple[int, int]]) -> None:
    """Recompute the given months from the whole bronze and overwrite them."""
    if not months:
        return
    silver = silver_for_months(derive_silver(read_bronze(spark, bronze_path)), months)
    write_month_partitions(sums(silver), gold_path, names=True)


def _notes(checkpoint_path: str) -> str:
    return checkpoint_path.rstrip("/") + "/touched"


def note_months(spark: SparkSession, checkpoint_path: str, batch_id: int, months: list[tuple[int, int]]) -> None:
    """Note that a batch touched ``months`` (again, if the batch is replayed)."""
    if months:
        months_frame(spark, months).coalesce(1).write.mode("overwrite").parquet(f"{_notes(checkpoint_path)}/batch={batch_id}")


def refresh_noted(spark: SparkSession, bronze_path: str, gold_path: str, checkpoint_path: str) -> list[tuple[int, int]]:
    """Refresh the months of all notes that are not done, each once; returns
    them."""
    root = _notes(checkpoint_path)
    done = {b for (b,) in partition_values(spark, root, "done")}
    todo = [b for (b,) in partition_values(spark, root, "batch") if b not in done]
    if not todo:
        return []
    rows = spark.read.schema("ano int, mes int").parquet(*[f"{root}/batch={b}" for b in todo]).distinct().collect()
    months = sorted((r["ano"], r["mes"]) for r in rows)
    refresh_months(spark, bronze_path, gold_path, months)
    for b in todo:
        make_folder(spark, f"{root}/done={b}")
    return months


def ingest_stream(spark: SparkSession, bronze_path: str, gold_path: str, checkpoint_path: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination()`` it).

    ``available_now`` (default) drains every new file and stops; the caller
    then calls ``refresh_noted`` (``run_stream_once`` does both).
    ``processing_time`` (e.g. ``"1 hour"``) keeps polling instead and
    refreshes after each batch.
    """
    reader = spark.readStream.schema(landed_schema()).option("basePath", bronze_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(bronze_path).select(S.SOURCE_COL)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        note_months(batch.sparkSession, checkpoint_path, batch_id, months_in(batch))
        if processing_time:
            refresh_noted(batch.sparkSession, bronze_path, gold_path, checkpoint_path)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_path)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_stream_once(spark: SparkSession, bronze_path: str, gold_path: str,
                    checkpoint_path: str, max_files_per_trigger: int | None = None) -> list[tuple[int, int]]:
    """Drain all new bronze files into gold; returns the months refreshed."""
    q = ingest_stream(spark, bronze_path, gold_path, checkpoint_path, available_now=True,
                      max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return refresh_noted(spark, bronze_path, gold_path, checkpoint_path)

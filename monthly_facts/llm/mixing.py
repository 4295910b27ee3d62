"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash. A source that shall give ``target`` words
out of ``size`` gives ``floor(target / size)`` whole copies of every document
and one more copy of the documents whose hash is below a threshold. The
thresholds come from histograms: words are summed by (source, top 12 bits of
the hash); the bucket in which the running sum crosses the budget is the only
one that is split again by the next 12 bits, until it holds one hash. Rows of
one hash that differ are split in the same way by a hash of all their columns;
of equal rows as many are taken as come nearest the budget, by their count.
Nothing is sorted but histogram rows, at most 4096 for a source and budget.

Budgets are nested: all use the same hashes, so what a smaller budget takes
is part of what a larger one takes.

Defined results: null text has size 0; sources are compared null-safely, a
null source is a source; documents that share an id (or a null id and a text)
share a hash, and at the threshold they are taken in the order of their
columns' hash, equal ones (which need not be told apart) up to a count; a
source without words has target 0; an empty table gives an empty result. A
source's words come within half of its boundary row of its target (a tie takes
the row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthly_facts.llm.tables import HASH_BITS, OWN, content_hash, repeated, row_hash, word_count, written

MAX_COPIES = 3
STEP_BITS = 12


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, source_size) of a (source, size) table; one row per source."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def cycled_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Adds ``weight`` 1, 2, ..., cycle, 1, ... in code point order, null last.

    The order is a distributed sort; positions come from the sizes of the
    sorted partitions, so no task sees more than its range of sources."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    schema = sources.withColumn("weight", F.lit(0).cast("bigint")).schema
    return sources.sparkSession.createDataFrame(
        ordered.map(lambda x: (*x[0], x[1] % cycle + 1)), schema)


def targets(weighted: DataFrame, fraction: float = 1.0, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target): ``fraction`` of all words shared by
    weight; no target above ``max_copies`` times its source's size, what is
    above shared again by weight among the others until none is above.

    One number comes to the driver per round: words for a weight of one."""
    cap = F.col("source_size") * max_copies
    total = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    share = (total[0] or 0) * fraction / (total[1] or 1)
    while True:
        above = F.col("weight") * F.lit(share) > cap
        capped, weight = weighted.agg(
            F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not weight:
            break
        again = ((total[0] or 0) * fraction - capped) / weight
        if again <= share:
            break
        share = again
    return weighted.select("source", "source_size",
                           F.least(F.col("weight") * F.lit(share), cap.cast("double")).alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """For each row of ``goals`` (source, budget, source_size, target): the
    whole copies ``copies`` and the boundary (``top``, ``top_content``): rows
    below it in (hash, content) are taken once more, and ``more`` of the equal
    rows at it. ``sized`` has (source, size, hash, content)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("copies", whole.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("copies") * F.col("source_size"))
    start = goals.where("rest > 0").select(
        F.col("source").alias("s"), "budget", "rest", F.lit(0.0).alias("below"), F.lit(None).cast("bigint").alias("at"))
    found, tied = _refined(sized, start, "hash")
    if tied is not None:
        found += _refined(sized, tied, "content")[0]
    count = F.floor((F.col("rest") - F.col("below")) / (F.col("words") / F.col("n")) + 0.5)
    ends = None
    for part in found:
        part = part.select("s", F.col("budget").alias("b"), F.col("low").alias("top"), F.col("low_content").alias("top_content"),
                           F.least("n", count).cast("bigint").alias("more"))
        ends = part if ends is None else ends.unionByName(part)
    return goals.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("budget") == F.col("b")), "left").select(
        "source", "budget", "source_size", "target", "copies",
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("top", "top_content")], F.coalesce("more", F.lit(0)).alias("more"))


def _refined(sized: DataFrame, start: DataFrame, column: str) -> tuple[list[DataFrame], DataFrame | None]:
    """Boundaries by the bits of ``column``, 12 a round, among the rows of a
    budget's source (and of the hash ``at``, if given): those that hold equal
    rows, and those of one hash whose rows differ (None if there are none)."""
    # below: words under the boundary bucket; the bucket is prefix at ``used`` bits.
    open_ = start.withColumn("prefix", F.lit(0).cast("bigint"))
    found, tied, used = [], None, 0
    while used < HASH_BITS:
        left = HASH_BITS - used
        within = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright(column, left) == F.col("prefix"))
        if column != "hash":
            within = within & (F.col("hash") == F.col("at"))
        keys = ["s", "at", "prefix"]
        inside = sized if not used and column == "hash" else sized.join(open_.select(*keys).distinct(), within, "left_semi")
        left -= STEP_BITS
        at = F.lit(None).cast("bigint") if column == "hash" else F.col("hash")
        histogram = inside.groupBy("source", at.alias("h"), F.shiftright(column, left).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count_if(F.col("size") > 0).alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"),
            *[f(F.when(F.col("size") > 0, F.col("content"))).alias(name) for f, name in ((F.min, "low_content"), (F.max, "high_content"))])
        joined = histogram.join(
            open_, F.col("source").eqNullSafe(F.col("s")) & F.col("h").eqNullSafe(F.col("at"))
            & (F.shiftright("bucket", STEP_BITS) == F.col("prefix")))
        running = Window.partitionBy("s", "budget").orderBy("bucket")
        upto = F.col("below") + F.sum("words").over(running)
        crossed = joined.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("words")).where(
            (F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("upto")))
        crossed = written(crossed.select("s", "budget", "rest", F.col("start").alias("below"), "at", F.col("bucket").alias("prefix"),
                                         "words", "n", "low", "high", "low_content", "high_content"), "mix-boundary")
        one, equal = F.col("low") == F.col("high"), F.col("low_content") == F.col("high_content")
        found.append(crossed.where(one & equal))
        open_ = crossed.select("s", "budget", "rest", "below", "at", "prefix")
        if column == "hash":
            differ = crossed.where(one & ~equal).select("s", "budget", "rest", "below", F.col("low").alias("at"))
            tied = differ if tied is None else tied.unionByName(differ)
            open_ = crossed.where(~one).select("s", "budget", "rest", "below", "at", "prefix")
        else:
            open_ = crossed.where(~equal).select("s", "budget", "rest", "below", "at", "prefix")
        used += STEP_BITS
        if open_.isEmpty():
            break
    return found, None if tied is None or tied.isEmpty() else tied


def _taken(hash_: str, content: str, prefix: str = "") -> tuple[Column, Column]:
    """Whether a row lies below its source's boundary, and whether at it."""
    top, at = F.col(prefix + "top"), F.col(prefix + "top_content")
    same = F.col(hash_) == top
    return (F.col(hash_) < top) | (same & (F.col(content) < at)), same & (F.col(content) == at)


def mix(docs: DataFrame, fractions: Sequence[float] = (1.0,), cycle: int = 3) -> DataFrame:
    """One row per document and budget: doc_id, source, size, hash,
    source_size, budget (the fraction of all words), target, copies (times
    the document is taken)."""
    sized = docs.select("doc_id", "source", word_count("text").alias("size"), row_hash().alias("hash"),
                        content_hash(docs.columns).alias("content"))
    sized = written(sized, "mix-sizes")
    weighted = written(cycled_weights(source_sizes(sized), cycle), "mix-sources")
    goals = None
    for f in fractions:
        part = targets(weighted, f).withColumn("budget", F.lit(float(f)))
        goals = part if goals is None else goals.unionByName(part)
    plan = written(thresholds(sized, written(goals, "mix-targets")), "mix-plan").withColumnRenamed("source", "s")
    # One row per source and budget; the planner broadcasts it by the size of
    # its files, or else splits a large source (skew join).
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("s")))
    below, edge = _taken("hash", "content")
    out = ["doc_id", "source", "size", "hash", "source_size", "budget", "target"]
    plain = rows.where(~edge).select(*out, (F.col("copies") + below.cast("bigint")).alias("copies"))
    edges = rows.where(edge).groupBy(*out, "copies", "more").agg(F.count(F.lit(1)).alias("times"))
    edges = repeated(edges, "times", "number")
    return plain.unionByName(edges.select(*out, (F.col("copies") + (F.col("number") <= F.col("more")).cast("bigint")).alias("copies")))


def mixed_documents(docs: DataFrame, fraction: float = 1.0, cycle: int = 3) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it."""
    columns = docs.columns
    sized = docs.select(F.col("source"), word_count("text").alias("size"), row_hash().alias("hash"),
                        content_hash(columns).alias("content"))
    sized = written(sized, "mix-sizes")
    weighted = written(cycled_weights(source_sizes(sized), cycle), "mix-sources")
    goals = written(targets(weighted, fraction).withColumn("budget", F.lit(float(fraction))), "mix-targets")
    plan = written(thresholds(sized, goals), "mix-plan")
    own = [F.col(c).alias(OWN + c) for c in ("source", "copies", "top", "top_content", "more")]
    rows = docs.withColumn(OWN + "hash", row_hash()).withColumn(OWN + "content", content_hash(columns)).join(
        plan.select(own), F.col("source").eqNullSafe(F.col(OWN + "source")))
    below, edge = _taken(OWN + "hash", OWN + "content", OWN)
    times = F.col(OWN + "copies") + below.cast("bigint")
    plain = rows.where(~edge).withColumn(OWN + "times", times).where(F.col(OWN + "times") > 0).withColumn(
        OWN + "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(OWN + "times"))))
    edges = rows.where(edge).groupBy(*columns, OWN + "copies", OWN + "more").agg(F.count(F.lit(1)).alias(OWN + "n")).withColumn(
        OWN + "times", F.col(OWN + "n") * F.col(OWN + "copies") + F.col(OWN + "more"))
    return plain.select(*columns).unionByName(repeated(edges, OWN + "times", OWN + "copy").select(*columns))

"""Sharding by extendible hashing, with DataFrame operations only.

A bucket is a prefix of the document's 60-bit hash; at first one bucket of no
bits holds everything. A bucket over the byte limit splits on the next bit,
until every bucket fits. The split is worked out on a histogram: bytes are
summed once by a prefix of ``g`` bits (a few more bits than shards are
needed), the sums of shorter prefixes come from the histogram, and a prefix
belongs to its shortest prefix that fits. That is the directory: 2^g entries
that name a bucket. Only entries that are still too large after g bits are
counted again with more bits, in directories of their own.

A bucket whose rows share one hash cannot be split by more of its bits. One
document over the limit stays alone in its bucket (``shard_bytes`` shows it).
Several such rows (one id with many texts or other columns) go on in a
directory of their own, by the bits of a hash of all their columns; equal rows
are cut into pages of as many rows as fit, from their count, without bringing
them together.

Defined results: null text has 0 bytes; a null id is hashed by its text; an
empty table gives an empty result; equal rows go to one bucket or its pages. A
shard holds at most ``limit`` bytes, or one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthly_facts.llm.tables import HASH_BITS, OWN, ROW_HASH_SQL, content_hash, content_hash_sql, repeated, row_hash, written

SHARD_BYTES = 64 << 20
# Bits of the histogram beyond those that equal buckets would need, and the
# bits of the directories below an entry that is still too large.
SPARE_BITS = 4
DEEPER_BITS = 8
MAX_FIRST_BITS = 24

_G, _H, _BYTES, _DEPTH, _LEAF, _ROWS, _NAME, _ABOVE = (
    OWN + x for x in ("group", "hash", "bytes", "depth", "leaf_bytes", "leaf_rows", "name", "above"))


def n_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def _prefix(bits: int) -> Column:
    return F.shiftright(_H, HASH_BITS - bits) if bits else F.lit(0).cast("bigint")


def _directory(keyed: DataFrame, above: int, bits: int, limit: int) -> DataFrame:
    """Entries (g: group; entry: prefix of above + bits bits; depth,
    leaf_bytes, leaf_rows of its bucket; depth null: still too large)."""
    finest = above + bits
    histogram = keyed.groupBy(F.col(_G).alias("g"), _prefix(finest).alias("entry")).agg(
        F.sum(_BYTES).alias("bytes"), F.count(F.lit(1)).alias("n"), F.min(_H).alias("low"), F.max(_H).alias("high"))
    shortest = 0 if not above else above + 1
    levels = histogram.withColumn("depth", F.explode(F.sequence(F.lit(shortest), F.lit(finest)))).withColumn(
        "prefix", F.expr(f"shiftright(entry, {finest} - depth)"))
    buckets = levels.groupBy("g", "depth", "prefix").agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    fits = buckets.where((F.col("bytes") <= limit) | (F.col("low") == F.col("high"))).select(
        "g", "depth", "prefix", F.struct("depth", "bytes", "n").alias("leaf"))
    # A left join keeps entries for which no prefix fits.
    return levels.select("g", "entry", "depth", "prefix").join(fits, ["g", "depth", "prefix"], "left").groupBy("g", "entry").agg(
        F.min("leaf").alias("leaf")).select(
        "g", "entry", F.col("leaf.depth").alias("depth"), F.col("leaf.bytes").alias("leaf_bytes"), F.col("leaf.n").alias("leaf_rows"))


def _directories(keyed: DataFrame, limit: int, bits: int) -> list[tuple[int, DataFrame]]:
    """Directories of ever more bits over (group, hash, bytes), each of the
    entries that are too large in the one before."""
    above, out = 0, []
    while True:
        directory = written(_directory(keyed, above, bits, limit), "shard-directory")
        out.append((above + bits, directory))
        above += bits
        large = directory.where("depth IS NULL").select("g", "entry")
        if above >= HASH_BITS or large.isEmpty():
            return out
        keyed = keyed.join(large, (F.col(_G) == F.col("g")) & (_prefix(above) == F.col("entry")), "left_semi")
        bits = min(DEEPER_BITS, HASH_BITS - above)


def _crowded(limit: int, leaf: str = _LEAF, rows: str = _ROWS) -> Column:
    return (F.col(leaf) > limit) & (F.col(rows) > 1)


def _any_crowded(directories: list[tuple[int, DataFrame]], limit: int) -> bool:
    return any(not d.where(_crowded(limit, "leaf_bytes", "leaf_rows")).isEmpty() for _, d in directories)


def _with_leaf(keyed: DataFrame, directories: list[tuple[int, DataFrame]]) -> DataFrame:
    """Each row's bucket, by one equality join per directory (the planner
    broadcasts a directory when its files are small)."""
    for k, (bits, directory) in enumerate(directories):
        names = [OWN + x for x in ("g", "entry", "d", "b", "n")]
        entries = directory.where("depth IS NOT NULL").toDF(*names)
        # An entry of an earlier directory already names the bucket, so at
        # most one directory has the row's prefix.
        keyed = keyed.join(entries, (F.col(_G) == F.col(names[0])) & (_prefix(bits) == F.col(names[1])), "left")
        for target, name in zip((_DEPTH, _LEAF, _ROWS), names[2:]):
            value = F.col(name) if not k else F.coalesce(F.col(target), F.col(name))
            keyed = keyed.withColumn(target, value)
        keyed = keyed.drop(*names)
    return keyed


def _bits() -> Column:
    return F.expr(f"CASE WHEN {_DEPTH} = 0 THEN '' ELSE lpad(bin(shiftright({_H}, {HASH_BITS} - {_DEPTH})), {_DEPTH}, '0') END")


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs`` with n_bytes, shard, depth and shard_bytes (a
    column of the input with one of these names is replaced)."""
    added = ["n_bytes", "shard", "depth", "shard_bytes"]
    columns = [c for c in docs.columns if c.lower() not in added]
    group = F.lit(0).cast("bigint")
    hashed = docs.select(*columns, group.alias(_G), row_hash().alias(_H), n_bytes().alias(_BYTES))
    keyed = written(hashed.select(_G, _H, _BYTES), "shard-keys")
    total = keyed.agg(F.sum(_BYTES)).first()[0] or 0
    bits = min(MAX_FIRST_BITS, max(1, math.ceil(math.log2(max(total, 1) / limit)) + SPARE_BITS))
    directories = _directories(keyed, limit, bits)
    leafed = _with_leaf(hashed, directories).withColumn(_NAME, F.concat(F.lit("s"), _bits()))
    any_crowded = _any_crowded(directories, limit)

    def result(rows: DataFrame, name: Column, depth: Column, held: Column) -> DataFrame:
        return rows.select(*columns, F.col(_BYTES).alias("n_bytes"), name.alias("shard"), depth.cast("int").alias("depth"), held.alias("shard_bytes"))

    plain = leafed.where(~_crowded(limit)) if any_crowded else leafed
    out = result(plain, F.col(_NAME), F.col(_DEPTH), F.col(_LEAF))
    if not any_crowded:
        return out
    # Rows of one hash: split by a hash of all their columns.
    again = leafed.where(_crowded(limit)).select(
        *columns, F.col(_H).alias(_G), content_hash(columns).alias(_H), _BYTES, F.col(_NAME), F.col(_DEPTH).alias(_ABOVE))
    directories = _directories(written(again.select(_G, _H, _BYTES), "shard-keys"), limit, DEEPER_BITS)
    leafed = _with_leaf(again, directories).withColumn(_NAME, F.concat(F.col(_NAME), F.lit("."), _bits())).withColumn(
        _DEPTH, F.col(_ABOVE) + F.col(_DEPTH))
    out = out.unionByName(result(leafed.where(~_crowded(limit)), F.col(_NAME), F.col(_DEPTH), F.col(_LEAF)))
    # Equal rows: pages of as many as fit.
    count, number, fit = (OWN + x for x in ("count", "number", "fit"))
    same = leafed.where(_crowded(limit)).groupBy(*columns, _BYTES, _NAME, _DEPTH).agg(F.count(F.lit(1)).alias(count)).withColumn(
        OWN + "n", F.col(count)).withColumn(fit, F.expr(f"greatest(1L, {limit} div greatest({_BYTES}, 1L))"))
    page = F.expr(f"({number} - 1) div {fit}")
    held = F.col(_BYTES) * F.least(F.col(fit), F.col(OWN + "n") - page * F.col(fit))
    return out.unionByName(result(repeated(same, count, number), F.concat(F.col(_NAME), F.lit("-"), page.cast("string")), F.col(_DEPTH), held))


def sharding_sql(limit: int = SHARD_BYTES, documents: str = "documents", columns: Sequence[str] = ("doc_id", "text")) -> str:
    """The same shards in SQL, bucket by bucket over all 60 depths of either
    hash. ``columns`` are those of the sharded table."""
    def bits(depth: str, h: str) -> str:
        return f"CASE WHEN {depth} = 0 THEN '' ELSE lpad(bin({h} >> (60 - {depth})), CAST({depth} AS INTEGER), '0') END"

    return f"""
WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) n_bytes, {ROW_HASH_SQL} h, {content_hash_sql(columns)} h2 FROM {documents}),
b AS (SELECT depth, h >> (60 - depth) prefix, CAST(sum(n_bytes) AS BIGINT) bytes, count(*) n
      FROM d, range(0, 61) t(depth) GROUP BY ALL
      HAVING sum(n_bytes) <= {limit} OR min(h) = max(h)),
leaf AS (SELECT d.h, min(struct_pack(depth := b.depth, bytes := b.bytes, n := b.n)) m
         FROM (SELECT DISTINCT h FROM d) d JOIN b ON b.prefix = d.h >> (60 - b.depth) GROUP BY ALL),
r AS (SELECT d.*, m.depth depth, m.bytes bytes, m.bytes > {limit} AND m.n > 1 crowded, 's' || {bits("m.depth", "d.h")} name
      FROM d JOIN leaf USING (h)),
b2 AS (SELECT h, t.depth, h2 >> (60 - t.depth) prefix, CAST(sum(n_bytes) AS BIGINT) bytes, count(*) n
       FROM r, range(0, 61) t(depth) WHERE crowded GROUP BY ALL HAVING sum(n_bytes) <= {limit} OR min(h2) = max(h2)),
leaf2 AS (SELECT d.h, d.h2, min(struct_pack(depth := b2.depth, bytes := b2.bytes, n := b2.n)) m
          FROM (SELECT DISTINCT h, h2 FROM r WHERE crowded) d JOIN b2 ON b2.h = d.h AND b2.prefix = d.h2 >> (60 - b2.depth) GROUP BY ALL),
r2 AS (SELECT r.doc_id, n_bytes, name || '.' || {bits("m.depth", "r.h2")} name, r.depth + m.depth depth, m.bytes bytes, m.bytes > {limit} AND m.n > 1 paged,
              greatest(1, {limit} // greatest(n_bytes, 1)) fit, row_number() OVER (PARTITION BY r.h, r.h2) - 1 k, m.n n
       FROM r JOIN leaf2 ON leaf2.h = r.h AND leaf2.h2 = r.h2 WHERE crowded)
SELECT doc_id, n_bytes, name shard, CAST(depth AS INTEGER) depth, bytes shard_bytes FROM r WHERE NOT crowded
UNION ALL
SELECT doc_id, n_bytes, CASE WHEN paged THEN name || '-' || (k // fit) ELSE name END, CAST(depth AS INTEGER),
       CAST(CASE WHEN paged THEN n_bytes * least(fit, n - (k // fit) * fit) ELSE bytes END AS BIGINT) FROM r2"""

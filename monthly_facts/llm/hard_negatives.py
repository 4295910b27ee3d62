"""Hard negatives by exact integer scores from a residue number system.

Components become integers, floor(scale * x). Scores are inner products of
integer vectors, worked out modulo several primes: a prime is so small that a
sum of products of residues (between -p/2 and p/2) stays below 2^24, so a
float32 matrix product of residues is exact in any order of its additions. The
residues of a score give the signed score itself by Chinese remaindering, one
mixed-radix digit per prime; there are as many primes as twice the largest
possible score needs.

Queries (anchors) meet rows in blocks: rows and anchors are dealt to blocks of
bounded size, a task gets one block of each, multiplies, and gives back what
may be among the first few of each anchor in its block. A window over those
picks the first ones. Positives are looked for among the anchor's label only,
then negatives among the other labels, inside the band that each positive sets.

Rows with a null label, a null vector or any null or non-finite component take
no part. Ties of scores are broken by the smaller id, null ids last. Shorter
vectors are padded with zeros. Repeated rows, and rows that share an id, are
rows of their own: only the anchor's own row is left out of its positives, and
each of several equal anchors has its results. Scores that may not fit 62 bits
are an error. An empty table, or one without anchors, gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthly_facts.llm.tables import written

SCALE = 256
FIRST = 5
# A negative's score lies between these shares (in percent) of the positive's.
LOW, HIGH = 80, 100
# float32 holds all integers up to this.
EXACT = 1 << 24
# Dimensions that are multiplied at once; longer vectors are summed in parts.
PART = 1024
# Integers of a block, and rows or anchors of it at most.
BLOCK_VALUES, BLOCK_ROWS = 4 << 20, 8192
# Anchors that are multiplied with a block at once.
ANCHORS_AT_ONCE = 256


def primes_for(dims: int, bound: int) -> list[int]:
    """The largest odd primes p with min(dims, PART) * (p // 2) ** 2 < EXACT,
    as many as make a product over 2 * bound."""
    half = math.isqrt((EXACT - 1) // max(1, min(dims, PART)))
    out, p, product = [], 2 * half + 1, 1
    while product <= 2 * bound:
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
            product *= p
        p -= 2
        if p < 3:
            raise ValueError("scores are too large")
    return out


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between -(p - 1) / 2 and (p - 1) / 2."""
    r = x % p
    return r - p * (r > p // 2)


class Residues:
    """Integer vectors (a row each) modulo every prime, as float32."""

    def __init__(self, vectors: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [[_centred(vectors[:, k:k + PART], p).astype(np.float32) for k in range(0, max(1, vectors.shape[1]), PART)]
                      for p in primes]

    def rows(self, first: int, last: int) -> Residues:
        out = object.__new__(Residues)
        out.primes, out.parts = self.primes, [[x[first:last] for x in parts] for parts in self.parts]
        return out


def scores(a: Residues, b: Residues) -> np.ndarray:
    """Inner products of all rows of a with all of b."""
    out, radix = None, 1
    for p, left, right in zip(a.primes, a.parts, b.parts):
        r = sum((x @ y.T).astype(np.int64) for x, y in zip(left, right))
        if out is None:
            out = _centred(r, p)
        else:
            # The digit that makes the sum so far right modulo p as well.
            out += _centred((r - out) % p * pow(radix, -1, p), p) * radix
        radix *= p
    return out


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0))
    values = np.asarray(column.flatten(), dtype=np.int64)
    if len(lengths) and (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def _by_id(table: pa.Table) -> pa.Table:
    """Rows by id, null last: a smaller place wins ties."""
    return table.sort_by([("id", "ascending"), ("row", "ascending")]) if table.num_rows else table


def _largest(scores_: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the n largest allowed entries of each line, of equal
    ones those of the smaller columns."""
    floor = np.iinfo(np.int64).min
    kept = np.where(allowed, scores_, floor)
    if kept.shape[1] > n:
        # All entries from the n-th largest on: few more than n, save for ties.
        least = np.partition(kept, kept.shape[1] - n, axis=1)[:, kept.shape[1] - n]
        kept[kept < least[:, None]] = floor
    line, column = np.nonzero(kept != floor)
    return _first_of_each(line, line, column, kept[line, column], n)


def _first_of_each(key: np.ndarray, line: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((column, -value, key))
    key = key[order]
    place = np.arange(len(key)) - np.searchsorted(key, key)
    chosen = order[place < n]
    return line[chosen], column[chosen]


def _block_size(dims: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, dims)))


def _dealt(df: DataFrame, own: str, blocks: Column, other: str, others: Column) -> DataFrame:
    """Every row in one of ``blocks``, once for each block of the other side."""
    return df.withColumn(own, F.pmod(F.xxhash64("row"), blocks)).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("bigint"), others - 1)))


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """``work(rows, anchors)`` for each pair of blocks."""
    anchors = anchors.toDF(*anchors.columns)  # columns of its own, as both may come from one table
    return rows.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInArrow(work, schema)


def _positives(rows: DataFrame, dims: int, primes: list[int], first: int) -> DataFrame:
    """(anchor row, id, score): each anchor's first rows of its label."""
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("n_anchors")).where("n_anchors > 0")
    per = _block_size(dims)
    sizes = written(sizes.selectExpr("label", f"CAST(ceil(n / {per}) AS BIGINT) AS row_blocks",
                                     f"CAST(ceil(n_anchors / {per}) AS BIGINT) AS anchor_blocks"), "rns-labels")
    sized = rows.join(sizes, "label")
    left = _dealt(sized, "rb", F.col("row_blocks"), "ab", F.col("anchor_blocks"))
    right = _dealt(sized.where("anchor"), "ab", F.col("anchor_blocks"), "rb", F.col("row_blocks"))
    columns = ["label", "rb", "ab", "row", "id", "q"]

    def work(r: pa.Table, a: pa.Table) -> pa.Table:
        r, found = _by_id(r), []
        if r.num_rows and a.num_rows:
            rq, aq = Residues(_matrix(r["q"], dims), primes), Residues(_matrix(a["q"], dims), primes)
            row, anchor = np.asarray(r["row"]), np.asarray(a["row"])
            for k in range(0, len(anchor), ANCHORS_AT_ONCE):
                s = scores(aq.rows(k, k + ANCHORS_AT_ONCE), rq)
                line, column = _largest(s, row[None, :] != anchor[k:k + ANCHORS_AT_ONCE, None], first)
                found.append((anchor[k + line], column, s[line, column]))
        line, column, value = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3
        return pa.table({"anchor": line, "id": r["id"].take(column), "score": value})

    id_type = rows.schema["id"].dataType.simpleString()
    tops = _met(left.select(columns), right.select(columns), ["label", "rb", "ab"], work,
                f"anchor bigint, id {id_type}, score bigint")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return tops.withColumn("place", F.row_number().over(order)).where(F.col("place") <= first)


def _negatives(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, dims: int, primes: list[int],
               first: int, low: int, high: int) -> DataFrame:
    """(anchor row, place of the positive, id, score, rank) of the first rows
    of other labels in each positive's band."""
    rb, ab = (F.lit(-(-n // _block_size(dims))).cast("bigint") for n in (n_rows, n_anchors))
    left = _dealt(rows, "rb", rb, "ab", ab).select("rb", "ab", "row", "id", "label", "q")
    right = _dealt(anchors, "ab", ab, "rb", rb).select("rb", "ab", "row", "label", "q", "bands")

    def work(r: pa.Table, a: pa.Table) -> pa.Table:
        r, found = _by_id(r), []
        if r.num_rows and a.num_rows:
            rq, aq = Residues(_matrix(r["q"], dims), primes), Residues(_matrix(a["q"], dims), primes)
            label, own, anchor = np.asarray(r["label"]), np.asarray(a["label"]), np.asarray(a["row"])
            bands = a["bands"].combine_chunks()
            n = np.asarray(bands.value_lengths())
            flat = bands.flatten()
            line, place = np.repeat(np.arange(len(n)), n), np.asarray(flat.field("place"))
            positive = np.asarray(flat.field("score"))
            least = np.full(len(n), np.iinfo(np.int64).max)
            np.minimum.at(least, line, -(-positive * low // 100))
            for k in range(0, len(anchor), ANCHORS_AT_ONCE):
                at = slice(k, k + ANCHORS_AT_ONCE)
                s = scores(aq.rows(k, k + ANCHORS_AT_ONCE), rq)
                # Few entries reach the lowest band of their anchor.
                x, column = np.nonzero((s >= least[at, None]) & (label[None, :] != own[at, None]))
                value = s[x, column]
                for j in np.unique(place).tolist():
                    band = np.full(len(n), -1)
                    band[line[place == j]] = np.flatnonzero(place == j)
                    mine = band[k + x]
                    p = positive[mine]
                    # Divided, not multiplied, so that large scores do not overflow.
                    fits = (mine >= 0) & (value >= -(-p * low // 100)) & (value <= p * high // 100)
                    one, col = _first_of_each(x[fits], x[fits], column[fits], value[fits], first)
                    found.append((anchor[k + one], np.full(len(one), j), col, s[one, col]))
        empty = (np.zeros(0, dtype=np.int64),) * 4
        line, place, column, value = (np.concatenate(x) for x in zip(*found)) if found else empty
        return pa.table({"anchor": line, "place": place.astype(np.int32), "id": r["id"].take(column), "score": value})

    id_type = rows.schema["id"].dataType.simpleString()
    tops = _met(left, right, ["rb", "ab"], work, f"anchor bigint, place int, id {id_type}, score bigint")
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)


def mined(vectors: DataFrame, is_anchor: Column, id_column: str = "vec_id", label_column: str = "label",
          vector_column: str = "embedding", scale: int = SCALE, first: int = FIRST, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor and each of its first positives the first
    negatives with ``low * positive <= 100 * negative <= high * positive``."""
    scaled = F.transform(vector_column, lambda x: x.cast("double") * scale)
    big = F.lit(2.0 ** 62)
    usable = F.col(label_column).isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)), F.lit(False))
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias(label_column), scaled.alias("v"),
                          F.coalesce(is_anchor, F.lit(False)).alias("anchor")).where(usable)
    # Components too large for an integer stay visible in the bound.
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "id", F.col(label_column).alias("label"), "anchor",
                               F.transform("v", lambda x: F.floor(F.greatest(F.least(x, big), -big))).alias("q")), "rns-rows")
    most, dims, n_rows, n_anchors = rows.agg(
        F.max(F.greatest(F.array_max("q"), -F.array_min("q"))), F.max(F.size("q")), F.count(F.lit(1)), F.count_if("anchor")).first()
    schema = T.StructType([
        T.StructField("anchor_id", rows.schema["id"].dataType), T.StructField("positive_id", rows.schema["id"].dataType),
        T.StructField("rank", T.IntegerType()), T.StructField("negative_id", rows.schema["id"].dataType),
        T.StructField("positive_score", T.LongType()), T.StructField("negative_score", T.LongType())])
    if not n_anchors:
        return vectors.sparkSession.createDataFrame([], schema)
    bound = (dims or 0) * (most or 0) ** 2
    if bound * max(100, low, high) >= 1 << 62:
        raise ValueError("scores may not fit: components are too large")
    dims, primes = max(1, dims or 0), primes_for(dims or 1, max(1, bound))
    positives = written(_positives(rows, dims, primes, first), "rns-positives")
    # At most ``first`` positives an anchor; a negative one has an empty band.
    bands = positives.where("score >= 0").groupBy("anchor").agg(F.collect_list(F.struct("place", "score")).alias("bands"))
    anchors = written(rows.where("anchor").join(bands.withColumnRenamed("anchor", "row"), "row"), "rns-anchors")
    negatives = _negatives(rows, anchors, n_rows, n_anchors, dims, primes, first, low, high)
    of = positives.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = negatives.join(of, ["anchor", "place"]).join(
        anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))


# The query of the contract in SQL: all scores, as doubles that hold them exactly.
MINED_SQL = f"""
WITH r AS (SELECT row_number() OVER () k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END l,
                  list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.k, a.vec_id anchor_id, b.vec_id, a.l = b.l same, CAST(list_inner_product(a.q, b.q) AS BIGINT) s
      FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.k <> b.k),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s DESC, vec_id NULLS LAST) n FROM s WHERE same QUALIFY n <= {FIRST}),
c AS (SELECT p.anchor_id, p.vec_id positive_id, p.s positive_score, s.vec_id negative_id, s.s negative_score,
             row_number() OVER (PARTITION BY p.k, p.n ORDER BY s.s DESC, s.vec_id NULLS LAST) rank
      FROM p JOIN s ON p.k = s.k AND NOT s.same AND {LOW} * p.s <= 100 * s.s AND 100 * s.s <= {HIGH} * p.s QUALIFY rank <= {FIRST})
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM c"""

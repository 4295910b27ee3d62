"""Near-duplicate classes: improved consistent weighted sampling of TF-IDF
shingles, banded, verified by weighted Jaccard similarity.

A document is its 5-word shingles (a text of one to four words is one
shingle), each with weight tf * idf, idf = 1 + log(documents / documents with
the shingle), to the base ``FLOOR``: 1 for a shingle in all documents, 2 for
one in a FLOOR-th of them, and more for rarer ones.

With ``every_shingle``, as the queries have it, that holds for every shingle.
Tasks send their documents' shingles to parts of the hashes (more of them for
more text); a part counts the documents of each of its shingles and sends the
counts above one back to each text, where they meet the text itself: its sketch
is made there, and the counts stay with it for the comparisons. No table of
shingles is held whole anywhere.

Without it idf is capped at 2, the share of a FLOOR-th, so that exact document
counts are needed for frequent shingles only. A shingle in more than 1/FLOOR of
all documents is in more than 1/FLOOR of the documents of some task, so each
task counts its documents' shingles in an array of fixed size (a slot per low
bits of the hash) and names the slots that are as frequent there; a second pass
counts the shingles of the named slots over all documents. Where texts are so
long that a task would hold less than ``GROUP_DOCS`` documents, tasks read
several partitions, so that chance does not make their slots frequent. What is
left is at most FLOOR times the mean number of shingles per document; it goes to
the executors as a broadcast variable, once each.

Samples: each of ``BANDS * ROWS`` samples is drawn over all of a document's
weighted shingles. For sample k a shingle of weight w has fixed random r and c
(Gamma(2, 1)) and b (uniform), t = floor(ln w / r + b), y = exp(r (t - b)) and
a = c / (y exp(r)); the shingle of the lowest a, with its t, is the sample. Two
documents agree in a sample with the probability of their weighted Jaccard
similarity. r and b come from a table of 2^16 points and c from one of 2^16
quantiles, addressed by bits of a hash of shingle and k, so that the common
weight (a shingle once in a text, of the highest idf) costs table look-ups only.
``BANDS`` bands of ``ROWS`` samples each name a bucket.

Links, in two steps. First all members of a bucket are held against one
member, the hub, by exact weighted Jaccard similarity; those of ``SIMILARITY``
or more are linked. That joins a large group in a number of comparisons that
follows its size. Then buckets whose members
are in more than one connected component are looked at again: pairs of
different components are compared exactly, the likeliest of each member first
and, when those link nothing more, all that are left; a pair counts in the
first band that it shares. Only pairs that cannot be similar are left out, by
a bound and not by an estimate: a document's outline is the weight that it has
in each of ``OUTLINE`` ranges of shingle hashes, rounded up, and two documents
share at most the sum of the lower ones of their outlines. There the members
outside a bucket's largest
component are the queries, held against all members in blocks of about
``MAX_BUCKET``; no pairs of one component are listed. Classes are the
connected components.

Equal texts are one node from the start (64-bit hash of the text; null counts
as empty), so a group of copies costs one row.

Defined results: the class id is the lowest doc_id of the class (null if all
are null); texts without words are in a class only with equal texts; repeated
rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthly_facts.llm.tables import OWN, written
from monthly_facts.llm.words import Block, blocks, gram_hashes, gram_starts, hash_spans, mix64, ranges

SHINGLE = 5
SIMILARITY = 0.8
FLOOR = 64
BANDS, ROWS = 25, 5
# Outlines: ranges of shingle hashes, and their steps to a unit of weight.
OUTLINE, STEPS = 256, 64
FIRST_PARTNERS = 1
MAX_BUCKET = 4096
GROUP_ROWS = 64
PAIRS_AT_ONCE = 1 << 14
BITMAP_BITS = 23
# Documents of a task that names frequent slots, at least.
GROUP_DOCS = 1024
# Documents of one block share a 64-bit key: 10 bits of document, 54 of hash.
DOC_BITS = 10
HASH_BITS = 64 - DOC_BITS
HASH_MASK = np.uint64((1 << (64 - DOC_BITS)) - 1)

# Parts of the hashes, as bits: 48 bits are left of a hash at most. Bytes of
# text to a part, about.
LEAST_PART_BITS = HASH_BITS - 48
PART_BYTES = 1 << 24

_U = np.uint64
_SLOT = _U((1 << BITMAP_BITS) - 1)
_MOST = 65535


def _shingles(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, 54-bit hash, count) of the block's different shingles, in
    order of document and hash."""
    hashes = block.hashes()
    n = block.n_words
    starts = gram_starts(block.word_offsets, SHINGLE)
    doc = np.searchsorted(block.word_offsets, starts, side="right") - 1
    keys = gram_hashes(hashes, SHINGLE)[starts] & HASH_MASK
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(few):
        # Hash of the words between the first and the last, one space between.
        texts = [b" ".join(block.span(a, a + k - 1).split()) for a, k in zip(block.word_offsets[few].tolist(), n[few].tolist())]
        data = np.frombuffer(b"".join(texts) + bytes(8), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        short = hash_spans(data, np.r_[0, ends[:-1]], ends) & HASH_MASK
        keys, doc = np.concatenate([keys, short]), np.concatenate([doc, few])
    keys = np.sort((doc.astype(np.uint64) << _U(64 - DOC_BITS)) | keys)
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, dtype=np.int64)
    keys = keys[edges[:-1]]
    return (keys >> _U(64 - DOC_BITS)).astype(np.int64), keys & HASH_MASK, np.diff(edges)


def _shingle_blocks(texts: pa.Array) -> Iterator[Block]:
    return blocks(texts, max_docs=1 << DOC_BITS)


class Weights:
    """idf of shingles: the frequent ones by their document counts, all
    others the highest."""

    common = 2.0

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        share = np.clip(counts[order] / max(total, 1), 1 / FLOOR, 1)
        self.idf = 1 - np.log(share) / np.log(FLOOR)

    def of(self, hashes: np.ndarray, counts: np.ndarray, docs: np.ndarray | None = None) -> np.ndarray:
        idf = np.full(len(hashes), self.common)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            idf[known] = self.idf[at[known]]
        return counts * idf


class FullWeights:
    """idf of shingles by the document counts of every one, ``docs``."""

    def __init__(self, total: int):
        self.total = max(total, 1)
        self.common = float(self._idf(np.ones(1))[0])

    def _idf(self, docs: np.ndarray) -> np.ndarray:
        return 1 - np.log(docs / self.total) / np.log(FLOOR)

    def of(self, hashes: np.ndarray, counts: np.ndarray, docs: np.ndarray | None = None) -> np.ndarray:
        return counts * self._idf(docs)


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of n equal parts, by bisection
    of 1 - (1 + x) exp(-x)."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(80):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return low


# By 16 bits of a hash: a pair of r and b (256 x 256), and a value of c.
_R = np.repeat(_gamma_quantiles(256), 256).astype(np.float32)
_B = np.tile((np.arange(256) + 0.5) / 256, 256).astype(np.float32)
_C = _gamma_quantiles(1 << 16).astype(np.float32)


def _step(ln_w: np.ndarray | float, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(t, 1 / (y exp(r))) at points of the table."""
    r, b = _R[at], _B[at]
    t = np.floor(ln_w / r + b)
    return t.astype(np.int64), np.exp(-r * (t - b + 1)).astype(np.float32)


@functools.cache
def _common_step(weight: float) -> tuple[np.ndarray, np.ndarray]:
    """(t, 1 / (y exp(r))) of the common weight at all points of the table."""
    return _step(np.float32(np.log(weight)), np.arange(1 << 16))


_SEEDS = (mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(32)).astype(np.uint32) | np.uint32(1)
# Shingles that are sampled at once, so that they stay in the cache (a longer
# document alone is more).
SAMPLED_AT_ONCE = 1 << 14


def _sample(hashes: np.ndarray, weights: np.ndarray, edges: np.ndarray, common: float) -> np.ndarray:
    """The samples of documents, whose shingles start at ``edges``."""
    n = len(hashes)
    common_t, common_share = _common_step(common)
    other = np.flatnonzero(weights != common)
    ln_w = np.log(weights[other]).astype(np.float32)
    low, high = hashes.astype(np.uint32), (hashes >> _U(32)).astype(np.uint32)
    x, y, at, share, c = np.empty(n, np.uint32), np.empty(n, np.uint32), np.empty(n, np.intp), np.empty(n, np.float32), np.empty(n, np.float32)
    # Little-endian pairs of name and a, compared as one number: positive
    # floats are in the order of their bits.
    pairs = np.empty((n, 2), dtype="<u4")
    out = np.empty((len(edges), len(_SEEDS)), dtype=np.uint64)
    for k, seed in enumerate(_SEEDS):
        np.multiply(low, seed, out=x)
        np.right_shift(x, 15, out=y)
        x ^= y
        x += high
        x *= np.uint32(0x2C1B3C6D)
        np.right_shift(x, 13, out=y)
        x ^= y
        np.right_shift(x, 16, out=y)
        at[:] = y
        np.take(common_share, at, out=share, mode="clip")
        pairs[:, 0] = x
        if len(other):
            # The sample's name is its shingle's hash and what its t has over
            # that of the common weight.
            t, share[other] = _step(ln_w, at[other])
            pairs[other, 0] += ((t - common_t[at[other]]) * 0x9E3779B1).astype(np.uint32)
        np.bitwise_and(x, 0xFFFF, out=y)
        at[:] = y
        np.take(_C, at, out=c, mode="clip")
        np.multiply(c, share, out=c)
        pairs[:, 1] = c.view(np.uint32)
        out[:, k] = np.minimum.reduceat(pairs.view("<u8")[:, 0], edges) & _U(0xFFFFFFFF)
    return out


def samples(block: Block, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """(documents with shingles, their samples)."""
    doc, hashes, counts = _shingles(block)
    return _samples(doc, hashes, weights.of(hashes, counts), weights.common)


def _samples(doc: np.ndarray, hashes: np.ndarray, w: np.ndarray, common: float) -> tuple[np.ndarray, np.ndarray]:
    if not len(doc):
        return np.zeros(0, dtype=np.int64), np.zeros((0, BANDS * ROWS), dtype=np.uint64)
    # Hashes of 54 bits are spread over 64 first.
    hashes = mix64(hashes)
    edges = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    ends = np.append(edges[1:], len(doc))
    parts, first = [], 0
    while first < len(edges):
        last = max(first + 1, int(np.searchsorted(ends, edges[first] + SAMPLED_AT_ONCE, side="right")))
        at = slice(edges[first], ends[last - 1])
        parts.append(_sample(hashes[at], w[at], edges[first:last] - edges[first], common))
        first = last
    return doc[edges], np.concatenate(parts)


def bands(sig: np.ndarray) -> np.ndarray:
    """BANDS bucket names per document."""
    out = np.zeros((len(sig), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), _U(b + 1))
        for k in range(ROWS):
            h = mix64(h * _U(0x9E3779B97F4A7C15) + sig[:, b * ROWS + k])
        out[:, b] = h
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, dtype=np.uint64).view(np.int64))


# ------------------------------------------------------- frequent shingles

def _frequent_slots(texts: DataFrame, total: int) -> DataFrame:
    """(slot): low bits of shingles in more than 1/FLOOR of the documents of
    some task; every shingle in more than 1/FLOOR of all has its slot here."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs = np.zeros(1 << BITMAP_BITS, dtype=np.uint16), 0   # up to _MOST, which then stands for more
        for batch in batches:
            for block in _shingle_blocks(batch.column(0)):
                slots, n = np.unique((_shingles(block)[1] & _SLOT).astype(np.int32), return_counts=True)
                counts[slots] = np.minimum(counts[slots] + n, _MOST)
                docs += len(block)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(counts > min(docs // FLOOR, _MOST - 1)))], names=["slot"])

    tasks = max(1, total // GROUP_DOCS)
    texts = texts.coalesce(tasks) if texts.rdd.getNumPartitions() > tasks else texts
    return texts.mapInArrow(read, "slot bigint").distinct()


def _bitmap(values: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the low bits of a column of hashes."""
    name = values.columns[0]
    bit = F.col(name).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = values.select(F.shiftright(bit, 5).alias("w"), F.expr(
        f"shiftleft(1L, CAST(`{name}` & 31 AS INT))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (BITMAP_BITS - 5), dtype=np.uint32)
    found = words.toPandas()  # at most 2^18 rows
    out[found["w"].to_numpy(dtype=np.int64)] = found["b"].to_numpy(dtype=np.int64).astype(np.uint32)
    return out


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = (hashes & _U((1 << BITMAP_BITS) - 1)).astype(np.int64)
    return (bitmap[low >> 5] >> (low & 31).astype(np.uint32)) & 1 == 1


def frequent_shingles(texts: DataFrame) -> Weights:
    """Exact document counts of the shingles in more than 1/FLOOR of all
    documents (``texts``: one column, one row per document)."""
    total = texts.count()
    bitmap = _bitmap(_frequent_slots(texts, total))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _shingle_blocks(batch.column(0)):
                found = _shingles(block)[1]
                found = found[_in_bitmap(bitmap, found)]
                found, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n)], names=["shingle", "n"])
    counts = texts.mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(
        F.sum("n").alias("n")).where(F.col("n") * FLOOR > total)
    found = counts.toPandas()  # at most FLOOR times the mean shingles of a document
    return Weights(found["shingle"].to_numpy(dtype=np.int64).view(np.uint64), found["n"].to_numpy(dtype=np.int64), total)


# ----------------------------------------------------------- every shingle

def _sent(keyed: DataFrame, bits: int) -> DataFrame:
    """(part, nodes, sizes, low, high): the different shingles of some
    documents in one part of the hashes, as many of each node as ``sizes``
    say, by their lowest 32 bits and the next 16."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.asarray(batch.column(0))
            for block in _shingle_blocks(batch.column(1)):
                doc, hashes, _ = _shingles(block)
                part = (hashes >> _U(HASH_BITS - bits)).astype(np.uint16 if bits <= 16 else np.int64)
                order = np.argsort(part, kind="stable")
                part, doc, hashes = part[order], doc[order], hashes[order] & _U((1 << (HASH_BITS - bits)) - 1)
                runs = np.flatnonzero((np.diff(part, prepend=part[:1] + 1) != 0) | (np.diff(doc, prepend=-1) != 0))
                first = np.flatnonzero(np.diff(part[runs], prepend=part[:1] + 1))
                at = np.append(runs[first], len(part))
                of = pa.array(np.append(first, len(runs)), type=pa.int32())
                low, high = hashes.astype("<u4"), (hashes >> _U(32)).astype("<u2")
                spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[at[:-1]], type=pa.int64()),
                    pa.ListArray.from_arrays(of, pa.array(nodes[block.first + doc[runs]], type=pa.int64())),
                    pa.ListArray.from_arrays(of, pa.array(np.diff(np.append(runs, len(part))), type=pa.int64())),
                    pa.array([low[a:b].tobytes() for a, b in spans], type=pa.binary()),
                    pa.array([high[a:b].tobytes() for a, b in spans], type=pa.binary())], names=["part", "nodes", "sizes", "low", "high"])
    return keyed.select("node", "text").mapInArrow(
        read, "part bigint, nodes array<bigint>, sizes array<bigint>, low binary, high binary")


def _document_counts(keyed: DataFrame, bits: int) -> DataFrame:
    """(node, part, shingles, docs): the shingles of each text that other
    documents have too, and how many documents have them."""
    def answers(part: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        nodes, sizes = (np.concatenate([r[k] for r in rows]) for k in range(2))
        low, high = (np.frombuffer(b"".join(r[k] for r in rows), dtype=t) for k, t in ((2, "<u4"), (3, "<u2")))
        hashes = (high.astype(np.uint64) << _U(32)) | low
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        edges = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1], True])
        docs = np.empty(len(hashes), dtype=np.int64)
        docs[order] = np.repeat(np.diff(edges), np.diff(edges))
        del order, sorted_, edges
        # Rows of equal texts have equal answers.
        _, once = np.unique(nodes, return_index=True)
        starts = np.cumsum(sizes) - sizes
        for i in range(0, len(once), 10_000):
            some = once[i:i + 10_000]
            at = ranges(starts[some], sizes[some])
            owner = np.repeat(np.arange(len(some)), sizes[some])
            keep = docs[at] > 1
            at, per = at[keep], np.bincount(owner[keep], minlength=len(some))
            have = per > 0
            of = pa.array(np.append(0, np.cumsum(per[have])), type=pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes[some[have]]), pa.array(np.full(int(have.sum()), part)),
                pa.ListArray.from_arrays(of, _signed(hashes[at] | (_U(part) << _U(HASH_BITS - bits)))),
                pa.ListArray.from_arrays(of, pa.array(docs[at]))], names=["node", "part", "shingles", "docs"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for part, nodes, sizes, low, high in zip(*(batch.column(k) for k in range(5))):
                if held and part.as_py() != now:
                    yield from answers(now, held)
                    held = []
                now = part.as_py()
                held.append((np.array(nodes.values), np.array(sizes.values), low.as_py(), high.as_py()))
        if held:
            yield from answers(now, held)
    return _sent(keyed, bits).repartition("part").sortWithinPartitions("part").mapInArrow(
        read, "node bigint, part bigint, shingles array<bigint>, docs array<bigint>")


def _once_a_task(keyed: DataFrame) -> DataFrame:
    """(node, text): each text once of each task, so that many copies are not
    many rows of one node."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, node in enumerate(batch.column(0).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    new.append(i)
            yield batch.take(pa.array(new, type=pa.int64()))
    return keyed.select("node", "text").mapInArrow(read, "node bigint, text string")


def _full_sketches(keyed: DataFrame, total: int, text_bytes: int) -> DataFrame:
    """(node, bands, docs): one row per different text that has words; docs
    are the document counts of its shingles, in order of their hashes."""
    bits = max(LEAST_PART_BITS, math.ceil(math.log2(max(text_bytes / PART_BYTES, 1))))
    counted = _document_counts(keyed, bits)
    rows = _once_a_task(keyed).select("node", F.lit(-1).cast("bigint").alias("part"), "text",
                        F.lit(None).cast("array<bigint>").alias("shingles"), F.lit(None).cast("array<bigint>").alias("docs")).unionByName(
        counted.withColumn("text", F.lit(None).cast("string"))).repartition("node").sortWithinPartitions("node", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = FullWeights(total)

        def sketched(table: pa.Table) -> Iterator[pa.RecordBatch]:
            node, part = (table.column(k).to_numpy() for k in range(2))
            # A text's row is its first; the others of the part -1 are copies.
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            texts = table.column(2).take(pa.array(first)).combine_chunks()
            told = table.filter(pa.array(part >= 0))
            shingles, docs = (told.column(k).combine_chunks().flatten().to_numpy() for k in (3, 4))
            owner = np.repeat(np.searchsorted(node[first], told.column(0).to_numpy()), pc.list_value_length(told.column(3)).to_numpy())
            for block in _shingle_blocks(texts):
                doc, hashes, counts = _shingles(block)
                n = np.ones(len(hashes), dtype=np.int64)
                a, b = np.searchsorted(owner, [block.first, block.first + len(block)])
                known = ((owner[a:b] - block.first).astype(np.uint64) << _U(HASH_BITS)) | shingles[a:b].view(np.uint64)
                n[np.searchsorted((doc.astype(np.uint64) << _U(HASH_BITS)) | hashes, known)] = docs[a:b]
                have, sig = _samples(doc, hashes, weights.of(hashes, counts, n), weights.common)
                edges = np.searchsorted(doc, np.append(have, len(block))).tolist()
                n = n.astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[first][have + block.first]),
                     pa.ListArray.from_arrays(np.arange(len(have) + 1, dtype=np.int32) * BANDS, _signed(bands(sig).ravel())),
                     pa.array([n[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], type=pa.binary())], names=["node", "bands", "docs"])
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            node = table.column(0).to_numpy()
            # The last node may go on in the next batch.
            cut = int(np.searchsorted(node, node[-1]))
            if cut:
                yield from sketched(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None:
            yield from sketched(held)
    return rows.select("node", "part", "text", "shingles", "docs").mapInArrow(read, "node bigint, bands array<bigint>, docs binary")


def _docs_of(docs: pa.Array, block: Block) -> np.ndarray | None:
    """The document counts of a block's shingles (null: not counted)."""
    of = docs.slice(block.first, len(block))
    return None if of.null_count else np.frombuffer(b"".join(of.to_pylist()), dtype="<i8")


# ------------------------------------------------------------------- nodes

def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"))


def _representatives(keyed: DataFrame) -> DataFrame:
    """(node, rep): the lowest document of each text (null last) and how many
    rows it has."""
    each = keyed.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("node").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "n")).alias("rep"))


def _sketches(keyed: DataFrame, shared: Broadcast[Weights]) -> DataFrame:
    """(node, bands, docs): one row per different text that has words."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for block in _shingle_blocks(batch.column(1)):
                have, sig = samples(block, weights)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(have + block.first)),
                     pa.ListArray.from_arrays(np.arange(len(have) + 1, dtype=np.int32) * BANDS, _signed(bands(sig).ravel()))],
                    names=["node", "bands"])
    found = keyed.select("node", "text").mapInArrow(read, "node bigint, bands array<bigint>")
    # Equal texts have equal sketches; partial aggregation keeps one per task.
    return found.groupBy("node").agg(F.any_value("bands").alias("bands")).withColumn("docs", F.lit(None).cast("binary"))


def outlines(block: Block, weights: Weights | FullWeights, docs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents with shingles, their weight, their outlines)."""
    doc, hashes, counts = _shingles(block)
    w = weights.of(hashes, counts, docs)
    have, row = np.unique(doc, return_inverse=True)
    at = row * OUTLINE + (hashes >> _U(64 - DOC_BITS - 8)).astype(np.int64)
    steps = np.ceil(np.bincount(at, weights=w, minlength=len(have) * OUTLINE) * STEPS)
    return have, np.bincount(row, weights=w, minlength=len(have)), np.minimum(steps, 65535).astype("<u2").reshape(-1, OUTLINE)


def _outlines(texts: DataFrame, shared: Broadcast[Weights | FullWeights]) -> DataFrame:
    """(node, weight, outline) of ``texts`` (node, text, docs)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for block in _shingle_blocks(batch.column(1)):
                have, weight, steps = outlines(block, weights, _docs_of(batch.column(2), block))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(have + block.first)), pa.array(weight),
                     pa.array([row.tobytes() for row in steps], type=pa.binary())], names=["node", "weight", "outline"])
    return texts.select("node", "text", "docs").mapInArrow(read, "node bigint, weight double, outline binary")


# ------------------------------------------------------------------- links

def _with_hub(entries: DataFrame) -> DataFrame:
    """``entries`` (bucket, node) of buckets with two members or more, each
    with its bucket's hub: the lowest node."""
    hubs = entries.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"))
    return entries.join(hubs.where("n > 1").select("bucket", "hub"), "bucket")


def _verified(pairs: DataFrame, texts: DataFrame, known: Broadcast[Weights | FullWeights], similarity: float) -> DataFrame:
    """Of ``pairs`` (node, hub) those at least ``similarity`` alike. A hub's
    members come in groups of about GROUP_ROWS, each sorted behind a copy of
    the hub's text and read as a stream."""
    sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    # Written, as both the members and the copies of the hubs come from it.
    salted = written(pairs.join(sizes, "hub").select(
        "hub", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / GROUP_ROWS)).alias("salt"), "node", F.lit(1).alias("member")), "near-salted")
    heads = salted.select("hub", "salt").distinct().select("hub", "salt", F.col("hub").alias("node"), F.lit(0).alias("member"))
    rows = salted.unionByName(heads).join(texts, "node").repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weights = None, known.value
        for batch in batches:
            hubs, nodes, members = (batch.column(k).to_pylist() for k in range(3))
            out = []
            for block in _shingle_blocks(batch.column(3)):
                doc, hashes, counts = _shingles(block)
                w = weights.of(hashes, counts, _docs_of(batch.column(4), block))
                edges = np.searchsorted(doc, np.arange(len(block) + 1))
                for d in range(len(block)):
                    own, own_w = hashes[edges[d]:edges[d + 1]], w[edges[d]:edges[d + 1]]
                    k = block.first + d
                    if not members[k]:
                        head, head_w, head_sum = own, own_w, own_w.sum()
                        continue
                    at = np.minimum(np.searchsorted(head, own), len(head) - 1)
                    both = head[at] == own
                    shared = np.minimum(head_w[at[both]], own_w[both]).sum()
                    if shared >= (similarity - 1e-9) * (head_sum + own_w.sum() - shared):
                        out.append((nodes[k], hubs[k]))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in (list(zip(*out)) or [(), ()])], names=["node", "hub"])
    return rows.select("hub", "node", "member", "text", "docs").mapInArrow(compare, "node bigint, hub bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the lowest node of each connected component of ``links``
    (node, hub). Labels move along links and from label to label, so a chain
    needs rounds as the logarithm of its length."""
    edges = written(links.select(F.col("node").alias("a"), F.col("hub").alias("b")).unionByName(
        links.select(F.col("hub").alias("a"), F.col("node").alias("b"))).distinct(), "near-edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "near-labels")
    while True:
        beside = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("m"))
        moved = labels.join(beside, labels["node"] == beside["a"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "m").alias("mid"))
        jump = labels.select(F.col("node").alias("p"), F.col("comp").alias("pc"))
        after = written(moved.join(jump, moved["mid"] == jump["p"], "left").select(
            "node", "old", F.least("mid", F.coalesce("pc", "mid")).alias("comp")), "near-labels")
        labels = after.select("node", "comp")
        if after.where("comp <> old").isEmpty():
            return labels


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after more ``links``: components of the components."""
    of = comps.select(F.col("node").alias("x"), F.col("comp").alias("c"))
    between = links.join(of, F.col("node") == F.col("x"), "left").select("hub", F.coalesce("c", "node").alias("node")).join(
        of, F.col("hub") == F.col("x"), "left").select("node", F.coalesce("c", "hub").alias("hub")).where("node <> hub").distinct()
    above = components(written(between, "near-between")).select(F.col("node").alias("x"), F.col("comp").alias("c"))
    ends = links.select("node").unionByName(links.select(F.col("hub").alias("node"))).distinct()
    all_ = comps.unionByName(ends.join(comps, "node", "left_anti").select("node", F.col("node").alias("comp")))
    return written(all_.join(above, F.col("comp") == F.col("x"), "left").select("node", F.coalesce("c", "comp").alias("comp")), "near-comps")


def _texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the ``wanted`` (node, rep), once each."""
    want = wanted.select(F.col("node").alias("w"), F.col("rep.doc_id").alias("d"), F.col("rep.n").alias("n"))
    # Most other documents are dropped where they are read, before the join.
    bitmap = _bitmap(wanted.select("node"))

    @F.pandas_udf("boolean")
    def perhaps(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for nodes in parts:
            yield pd.Series(_in_bitmap(bitmap, nodes.to_numpy().view(np.uint64)))

    rows = keyed.where(perhaps("node")).join(want, (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("d")))
    once = rows.where("n = 1").select("node", "text")
    if wanted.where("rep.n > 1").isEmpty():
        return once
    return once.unionByName(rows.where("n > 1").select("node", "text").dropDuplicates(["node"]))


def _blocks_of_buckets(members: DataFrame, comps: DataFrame, outlined: DataFrame) -> DataFrame:
    """Rows (block, node, comp, asks, weight, outline, bands, band) of buckets whose
    members (bucket, node) are in more than one component. Members outside the bucket's largest
    component ask, all members are asked; a bucket of more than MAX_BUCKET is
    dealt into blocks so that each asking member meets each other member in
    one of them."""
    of = members.select("bucket", "node").join(comps, "node", "left").select(
        "bucket", "node", F.coalesce("comp", "node").alias("comp"))
    sizes = of.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    rows = of.join(sizes, "bucket").join(outlined, "node").select(
        "bucket", "node", "comp", "weight", "outline", "bands", F.array_position("bands", F.col("bucket")).alias("band"), (F.col("comp") != F.col("main.comp")).alias("asks"),
        F.ceil(F.col("n") / MAX_BUCKET).alias("k"), F.ceil((F.col("n") - F.col("main.n")) / MAX_BUCKET).alias("kq"))
    own, zero = F.xxhash64("node"), F.lit(0).cast("bigint")
    asked = rows.withColumn("asks", F.lit(False)).withColumn("i", F.pmod(own, F.col("k"))).withColumn(
        "q", F.explode(F.sequence(zero, F.col("kq") - 1)))
    asking = rows.where("asks").withColumn("i", F.explode(F.sequence(zero, F.col("k") - 1))).withColumn("q", F.pmod(own, F.col("kq")))
    return asked.unionByName(asking).select(F.xxhash64("bucket", "i", "q").alias("block"), "node", "comp", "asks", "weight", "outline", "bands",
                                            (F.col("band") - 1).cast("int").alias("band"))


def most_shared(weight: np.ndarray, outline: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The highest similarity that the outlines of x and y leave possible."""
    lower = np.minimum(outline[x], outline[y])
    either = np.minimum(weight[x], weight[y])
    # A number at its limit may stand for any weight.
    shared = np.where((lower == 65535).any(axis=1), either, np.minimum(lower.sum(axis=1, dtype=np.int64) / STEPS, either))
    return shared / (weight[x] + weight[y] - shared)


def _possible(rows: DataFrame, partners: int | None, similarity: float) -> DataFrame:
    """(node, hub): pairs of members of one block and different components
    that may be similar; the likeliest ``partners`` of each asking member, or
    all."""
    def pairs_of(block):
        nodes, comps, asks, weight, outline, keys, band = block
        asking = np.flatnonzero(asks)
        asked = np.flatnonzero(~asks)
        step = max(PAIRS_AT_ONCE // max(len(asked), 1), 1)
        for i in range(0, len(asking), step):
            part = asking[i:i + step]
            x, y = np.nonzero(comps[part, None] != comps[None, asked])
            x, y = part[x], asked[y]
            lower, upper = np.minimum(weight[x], weight[y]), np.maximum(weight[x], weight[y])
            keep = np.flatnonzero(lower >= (similarity - 1e-6) * upper)
            x, y = x[keep], y[keep]
            new = ~(keys[x, :band[0]] == keys[y, :band[0]]).any(axis=1)
            x, y = x[new], y[new]
            most = most_shared(weight, outline, x, y)
            keep = np.flatnonzero(most >= similarity - 1e-6)
            if partners is not None:
                keep = keep[np.lexsort((-most[keep], x[keep]))]
                first = np.searchsorted(x[keep], x[keep])
                keep = keep[np.arange(len(keep)) - first < partners]
            a, b = nodes[x[keep]], nodes[y[keep]]
            yield np.stack([np.minimum(a, b), np.maximum(a, b)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        out: list[np.ndarray] = []

        def result():
            found = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((2, 0), dtype=np.int64)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[1]), pa.array(found[0])], names=["node", "hub"])

        def results(block):
            for pairs in pairs_of(block):
                out.append(pairs)
                if sum(p.shape[1] for p in out) > 8 * PAIRS_AT_ONCE or len(out) > 256:
                    yield result()
        for batch in batches:
            if not batch.num_rows:
                continue
            steps = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype="<u2").reshape(-1, OUTLINE)
            more = [np.asarray(batch.column(k)) for k in range(5)] + [
                steps, np.asarray(batch.column(6).flatten()).reshape(-1, BANDS), np.asarray(batch.column(7))]
            held = [np.concatenate([h, m]) for h, m in zip(held, more)] if held else more
            edges = np.flatnonzero(np.r_[True, held[0][1:] != held[0][:-1]])
            # The last block may go on in the next batch.
            for a, b in zip(edges[:-1], edges[1:]):
                yield from results([h[a:b] for h in held[1:]])
            held = [h[edges[-1]:] for h in held]
        if held:
            yield from results(held[1:])
        yield result()
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(read, "node bigint, hub bigint").distinct()


def _linked(keyed: DataFrame, reps: DataFrame, similarity: float, every_shingle: bool) -> DataFrame:
    """(node, comp) of all nodes that have a link."""
    share = keyed.sparkSession.sparkContext.broadcast
    if every_shingle:
        total, text_bytes = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        weights = share(FullWeights(total))
        sketches = written(_full_sketches(keyed, total, text_bytes), "near-sketches")
    else:
        weights = share(frequent_shingles(keyed.select("text")))
        sketches = written(_sketches(keyed, weights), "near-sketches")
    counts, sketches = sketches.select("node", "docs"), sketches.select("node", "bands")
    members = written(_with_hub(sketches.select(F.explode("bands").alias("bucket"), "node")), "near-members")
    wanted = written(members.select("node").distinct().join(reps, "node"), "near-wanted")
    texts = written(_texts(keyed, wanted).join(counts, "node"), "near-texts")
    tested = written(members.where("node <> hub").select(
        F.greatest("node", "hub").alias("node"), F.least("node", "hub").alias("hub")).distinct(), "near-pairs")
    links = written(_verified(tested, texts, weights, similarity), "near-links")
    comps = components(links)
    outlined = written(_outlines(texts, weights).join(sketches, "node"), "near-outlines")
    partners: int | None = FIRST_PARTNERS
    while True:
        found = _possible(_blocks_of_buckets(members, comps, outlined), partners, similarity)
        found = written(found.join(tested, ["node", "hub"], "left_anti"), "near-pairs")
        new = written(_verified(found, texts, weights, similarity), "near-links")
        linked = not new.isEmpty()
        if linked:
            comps = _joined(comps, new)
        if partners is None:
            # All possible pairs across components were compared; joining
            # components makes no new ones.
            return comps
        tested = tested.unionByName(found)
        partners = FIRST_PARTNERS if linked else None


def classes(docs: DataFrame, similarity: float = SIMILARITY, every_shingle: bool = False) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, (node, rep) where rep is the lowest document of the
    node's class)."""
    keyed = _keyed(docs)
    reps = written(_representatives(keyed), "near-reps")
    comps = _linked(keyed, reps, similarity, every_shingle)
    labelled = reps.join(comps, "node", "left").select("node", "rep", F.coalesce("comp", "node").alias("comp"))
    lowest = labelled.groupBy("comp").agg(F.min("rep").alias("rep"))
    return keyed, written(labelled.select("node", "comp").join(lowest, "comp").select("node", "rep"), "near-classes")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, every_shingle: bool = False) -> DataFrame:
    """doc_id, class_id: one row per row of ``docs``."""
    keyed, of = classes(docs, similarity, every_shingle)
    return keyed.select("doc_id", "node").join(of, "node").select("doc_id", F.col("rep.doc_id").alias("class_id"))


def unique_documents(docs: DataFrame, similarity: float = SIMILARITY, every_shingle: bool = False) -> DataFrame:
    """One row of ``docs`` of each class: its lowest document."""
    node, d = OWN + "node", OWN + "d"
    _, of = classes(docs, similarity, every_shingle)
    kept = written(of.where(F.col("rep.node") == F.col("node")).select(
        F.col("node").alias(node), F.col("rep.doc_id").alias(d), F.col("rep.n").alias(OWN + "n")), "near-kept")
    rows = docs.join(kept, (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(node))
                     & F.col("doc_id").cast("bigint").eqNullSafe(F.col(d)))
    once = rows.where(F.col(OWN + "n") == 1).select(*docs.columns)
    if kept.where(F.col(OWN + "n") > 1).isEmpty():
        return once
    return once.unionByName(rows.where(F.col(OWN + "n") > 1).dropDuplicates([node]).select(*docs.columns))

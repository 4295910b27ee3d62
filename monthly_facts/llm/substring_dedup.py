"""Substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the
5-word gram with the lowest hash in it. Consecutive windows that share a
minimiser form a super-k-mer: one packed string of their words (a stretch of
repeated words is one super-k-mer, not one per repetition). Equal windows have equal minimisers, so a bucket per
minimiser sees all copies of its windows, and reading a bucket in document
order finds for each window whether its words started earlier.

What travels:

1. (minimiser, document, occurrences), once per document; minimisers that
   occur once in the corpus cannot hold a repeated window and go no further.
2. The documents meet the list of their repeated minimisers and send those
   super-k-mers as packed strings. Equal strings of one block of documents
   are settled there: only the first travels, the others are covered whole.
   So a passage that a third of all documents share sends one string per
   block, not per document.
3. Buckets are sorted by document and start and read as a stream. A minimiser
   with more than ``HOT`` occurrences sends its windows one by one, to a
   bucket per window.
4. The covered ranges go back to their documents.

Windows are compared as their words, byte by byte, within a bucket; hashes
only bring them together.

Defined results: null text has no words; documents are ordered by doc_id
(null last), then by the hash of their text; equal rows (same id and text) are
one document: they do not cover each other and get the same result; texts
under 20 words lose nothing; an empty table gives an empty result. Texts are
handled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthly_facts.llm.tables import written
from monthly_facts.llm.words import Block, blocks, gram_hashes, gram_starts, mix64

WINDOW = 20
GRAM = 5
HOT = 5000

_SEED = np.uint64(0x9E3779B97F4A7C15)


def _first_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the position of the lowest of ``width`` values, the
    first of equals."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        have += step
    return at


def super_kmers(block: Block, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window's word, number of windows, minimiser hash,
    places of the minimiser) of each run of windows that share a minimiser, in
    text order."""
    starts = gram_starts(block.word_offsets, window)
    if not len(starts):
        return starts, starts, starts, np.zeros(0, dtype=np.uint64), starts
    grams = gram_hashes(block.hashes(), GRAM)
    at = _first_lowest(grams, window - GRAM + 1)[starts]
    doc = np.searchsorted(block.word_offsets, starts, side="right") - 1
    moved = np.r_[True, at[1:] != at[:-1]]
    edges = np.flatnonzero(np.r_[True, (grams[at[1:]] != grams[at[:-1]]) | (doc[1:] != doc[:-1])])
    return doc[edges], starts[edges], np.diff(np.r_[edges, len(starts)]), grams[at[edges]], np.add.reduceat(moved.astype(np.int64), edges)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("doc_key"))


def _minimisers(keyed: DataFrame, window: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for block in blocks(batch.column(0)):
                doc, _, _, lowest, places = super_kmers(block, window)
                _, at, back = np.unique(mix64(lowest + doc.astype(np.uint64) * _SEED), return_index=True, return_inverse=True)
                sums = np.bincount(back, weights=places, minlength=len(at)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [_signed(lowest[at]), pa.array(keys[block.first + doc[at]]), pa.array(sums)], names=["m", "doc_key", "n"])
    return keyed.select("text", "doc_key").mapInArrow(read, "m bigint, doc_key bigint, n bigint")


def _in_sets(doc: np.ndarray, values: np.ndarray, sets: pa.Array, marks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in its document's list, and the mark beside it."""
    offsets = np.asarray(sets.offsets)
    flat, mark = np.asarray(sets.values).view(np.uint64), np.asarray(marks.values)
    owner = np.repeat(np.arange(len(sets)), np.diff(offsets))
    flat, mark = flat[offsets[0]:offsets[-1]], mark[offsets[0]:offsets[-1]]
    known = mix64(flat + owner.astype(np.uint64) * _SEED)
    order = np.argsort(known)
    known, mark = known[order], mark[order]
    asked = mix64(values + doc.astype(np.uint64) * _SEED)
    at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
    if not len(known):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=bool)
    found = known[at] == asked
    return found, found & mark[at]


# A row travels to a bucket: the windows' words (packed), or a range that is
# already known to be covered (packed null).
_TRAVEL = "bucket bigint, doc_id bigint, doc_key bigint, start bigint, n bigint, packed binary"


def _packed(candidates: DataFrame, window: int) -> DataFrame:
    """``candidates``: doc_id, doc_key, text, ms (repeated minimisers of the
    document), hot (which of them are hot)."""
    def order(doc_id, doc_key, start):
        return doc_id is None, doc_id or 0, doc_key, start

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, doc_keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in blocks(batch.column(2)):
                doc, first, count, lowest, _ = super_kmers(block, window)
                rows = slice(block.first, block.first + len(block))
                sets, marks = batch.column(3)[rows], batch.column(4)[rows]
                found, hot = _in_sets(doc, lowest, sets, marks)
                firsts: dict[tuple[int, bytes], tuple] = {}
                out: list[tuple] = []

                def meet(bucket, row, packed, n):
                    """The earliest row of equal strings travels; the others
                    are covered."""
                    have = firsts.get((bucket, packed))
                    if have is None:
                        firsts[bucket, packed] = (row, n)
                    elif order(*row) < order(*have[0]):
                        firsts[bucket, packed] = (row, n)
                        out.append((have[0], n))
                    elif row != have[0]:
                        out.append((row, n))

                at = block.word_offsets
                for k in np.flatnonzero(found).tolist():
                    d, w, n = int(doc[k]), int(first[k]), int(count[k])
                    start = w - int(at[d])
                    doc_id, doc_key, bucket = doc_ids[block.first + d], doc_keys[block.first + d], int(lowest[k].view(np.int64))
                    words = block.span(w, w + n + window - 2).split()
                    if not hot[k]:
                        meet(bucket, (doc_id, doc_key, start), b" ".join(words), n)
                    else:
                        for j in range(n):
                            packed = b" ".join(words[j:j + window])
                            own = int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), "big", signed=True)
                            meet(own, (doc_id, doc_key, start + j), packed, 1)
                covered = [(row[1] ^ row[2], *row, n, None) for row, n in out]
                travelling = [(bucket, *row, n, packed) for (bucket, packed), (row, n) in firsts.items()]
                columns = list(zip(*(covered + travelling))) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.binary()])],
                    names=["bucket", "doc_id", "doc_key", "start", "n", "packed"])
    return candidates.select("doc_id", "doc_key", "text", "ms", "hot").mapInArrow(read, _TRAVEL)


def _covered_ranges(travelled: DataFrame, window: int) -> DataFrame:
    """(doc_id, doc_key, start, stop) of words covered by a window that starts
    earlier elsewhere; ``travelled`` is sorted by bucket and order."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seen, doc, doc_no = None, {}, None, 0
        for batch in batches:
            out: list[tuple] = []
            for b, doc_id, doc_key, start, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if packed is None:
                    out.append((doc_id, doc_key, start, start + n + window - 1))
                    continue
                if b != bucket:
                    bucket, seen, doc, doc_no = b, {}, None, 0
                if doc != (doc_id, doc_key):
                    doc, doc_no = (doc_id, doc_key), doc_no + 1
                # Where each word starts, were there a space behind the last.
                at = list(accumulate((len(w) + 1 for w in packed.split(b" ")), initial=0))
                since = None
                for k in range(n):
                    words = packed[at[k]:at[k + window] - 1]
                    here = (doc_no, start + k)
                    if seen.setdefault(words, here) != here:
                        since = k if since is None else since
                    elif since is not None:
                        out.append((doc_id, doc_key, start + since, start + k + window - 1))
                        since = None
                if since is not None:
                    out.append((doc_id, doc_key, start + since, start + n + window - 1))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns],
                                             names=["doc_id", "doc_key", "start", "stop"])
    return travelled.mapInArrow(read, "doc_id bigint, doc_key bigint, start bigint, stop bigint")


def covered(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(documents with their doc_key, covered word ranges per document)."""
    keyed = _keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    found = _minimisers(keyed, window)
    # Partial sums before the exchange. Written, so that the join below has a
    # plain exchange on either side and a minimiser of very many documents can
    # be split by the skew join.
    repeated = written(found.groupBy("m").agg(F.sum("n").alias("n")).where("n > 1").select(
        "m", (F.col("n") > hot).alias("h")), "substring-minimisers")
    sets = (
        found.select("m", "doc_key").join(repeated, "m")
        .groupBy("doc_key").agg(F.collect_set(F.struct("m", "h")).alias("l"))
        .select("doc_key", F.col("l.m").alias("ms"), F.col("l.h").alias("hot"))
    )
    travelled = _packed(keyed.join(sets, "doc_key"), window)
    sorted_ = travelled.repartition("bucket").sortWithinPartitions(
        "bucket", F.col("doc_id").asc_nulls_last(), "doc_key", "start")
    ranges = _covered_ranges(sorted_, window).groupBy("doc_key").agg(
        F.collect_set(F.struct("doc_id", "start", "stop")).alias("ranges"))
    return keyed, ranges


def _kept_words(text: str | None, doc_id, ranges) -> tuple[list[bytes], int]:
    words = (text or "").encode().split()
    gone = np.zeros(len(words), dtype=bool)
    for r in ranges or ():
        # Another document can share the key's hash, but not also the id.
        if r["doc_id"] == doc_id:
            gone[r["start"]:r["stop"]] = True
    return [w for w, g in zip(words, gone.tolist()) if not g] if len(gone) and gone.any() else words, len(words)


def deduplicated(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by a space)."""
    keyed, ranges = covered(docs, window, hot)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            kept = [_kept_words(t.as_py(), i, r.as_py()) for i, t, r in zip(ids, batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for _, n in kept], type=pa.int64()),
                 pa.array([n - len(w) for w, n in kept], type=pa.int64()),
                 pa.array([b" ".join(w).decode() for w, _ in kept], type=pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])
    return keyed.join(ranges, "doc_key", "left").select("doc_id", "text", "ranges").mapInArrow(
        cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def digested(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    out = deduplicated(docs, window, hot)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

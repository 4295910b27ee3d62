"""Bounded-space online packing of tokenized documents into sequences.

Each task reads its partition once. A document's ids (its tokens, then the end
id) are cut into whole sequences and a rest. The task holds a fixed number of
open windows; a rest goes to the fullest window that still has room for it
(best fit). When none has, the fullest window is emitted: it takes the head of
the rest if both parts of such a cut are ``min_cut`` ids or longer, else its
gap, shorter than that or next to a short rest, is padding. What is left of the
rest opens a new window.

A partition leaves at most ``windows`` open windows. Those of ``FAN``
neighbouring partitions are packed in the same way by one task, whose open
windows go on to the next round, until one group is left: a tree of rounds,
each task bounded by ``FAN * windows`` sequences. The last open windows are
poured together, and the one sequence that remains is cut at powers of two,
lengths that need no padding.

The tokenizer never joins characters of two words (runs without space and
0x09-0x0D), so the ids of a text are those of its words in a row. Each different
word, or run of one kind of characters in a plain ASCII word, is tokenized once
per worker and remembered by a 64-bit hash.

Result of ``packed``: a row per piece: doc_id, start (ids of the document before
it), length, doc_tokens, sequence_id, offset (place in the sequence), ids
(little-endian unsigned 32-bit). Every id lies in one piece. The same files and
splits give the same pieces, so a task that runs again writes what it wrote.

Defined results: null and empty texts are the end id alone; repeated rows and
ids are packed as rows of their own; a null id stays null; a long text is cut
into as many sequences as it fills, memory follows the longest text; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthly_facts.llm.tables import written
from monthly_facts.llm.words import Block, blocks, hash_spans, ranges

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
LENGTH = 4096
WINDOWS = 32
MIN_CUT = 16
# Partitions (or groups of an earlier round) whose open windows one task merges.
FAN = 16
CACHED_UNITS = 1_000_000
# A word of its own, one id, rare in texts.
MARK = "\x01"
BATCH_BYTES = 4 << 20
# sequence_id: round, then task, then the task's count of sequences.
TASK_BITS = COUNT_BITS = 28

Piece = tuple  # (doc_id, start, ids, doc_tokens)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Bytes of words that are cut further, into what the tokenizer's own pattern
# finds in plain ASCII: runs of letters, single digits, runs of other signs.
# Words with an apostrophe (contractions), a bar (special tokens) or any other
# byte are units as a whole.
_OTHER, _LETTER, _DIGIT = 1, 2, 3
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = _OTHER
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[0x27, 0x7C]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class UnitTokens:
    """Ids of units (parts of words that are tokenized by themselves). They
    are remembered in sorted arrays by the units' hashes, about 30 bytes each;
    when there are too many, those that were last met longest ago go."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self._ids(MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        self.keys = np.zeros(0, dtype=np.uint64)
        self.first, self.met = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.count = np.zeros(0, dtype=np.int32)
        self.ids, self.used, self.block = np.zeros(1 << 16, dtype="<u4"), 0, 0

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _wholes(self, words: list[str]) -> Iterator[np.ndarray]:
        """Ids of words, many in one call with a mark between them; one by one
        if a word holds the mark itself."""
        for k in range(0, len(words), 1000):
            part = words[k:k + 1000]
            found = np.array(self._ids(f" {MARK} ".join(part)), dtype="<u4")
            cuts = np.flatnonzero(found == self.mark) if self.mark is not None else ()
            if len(cuts) == len(part) - 1:
                for start, end in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(found)]):
                    yield found[start:end]
            else:
                yield from (np.array(self._ids(w), dtype="<u4") for w in part)

    def _learn(self, at: np.ndarray, keys: np.ndarray, units: list[str], plain: np.ndarray) -> None:
        tokenize, found = self.tokenizer.model.tokenize, [None] * len(units)
        for k in np.flatnonzero(plain).tolist():
            found[k] = [t.id for t in tokenize(units[k])]
        whole = np.flatnonzero(~plain).tolist()
        for k, ids in zip(whole, self._wholes([units[k] for k in whole])):
            found[k] = ids
        count = np.fromiter(map(len, found), dtype=np.int32, count=len(found))
        total = int(count.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + total] = np.fromiter(itertools.chain.from_iterable(found), dtype="<u4", count=total)
        first = self.used + np.cumsum(count, dtype=np.int64) - count
        self.used += total
        self.keys, self.first = np.insert(self.keys, at, keys), np.insert(self.first, at, first)
        self.count, self.met = np.insert(self.count, at, count), np.insert(self.met, at, self.block)

    def _forget(self) -> None:
        """Keep the half that was met last."""
        keep = self.met > np.partition(self.met, len(self.met) // 2)[len(self.met) // 2]
        ids = self.ids[ranges(self.first[keep], self.count[keep].astype(np.int64))]
        self.keys, self.count, self.met = self.keys[keep], self.count[keep], self.met[keep]
        self.first = np.cumsum(self.count, dtype=np.int64) - self.count
        self.ids, self.used = np.concatenate([ids, np.zeros(1 << 16, dtype="<u4")]), len(ids)

    def units(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the block's units, whether each is plain, and
        the bytes they lie in (plain words in lower case)."""
        kind = _KIND[block.data]
        # A word is plain if no byte of it has kind 0.
        odd = np.zeros(len(kind) + 1, dtype=np.int64)
        np.cumsum(kind == 0, out=odd[1:])
        plain = odd[block.ends] == odd[block.starts]
        # +1 where a plain word starts, -1 where one ends (a next one may start there).
        steps = np.zeros(len(kind) + 1, dtype=np.int8)
        steps[block.starts[plain]] = 1
        steps[block.ends[plain]] -= 1
        inside = np.cumsum(steps[:-1], dtype=np.int8).view(bool)
        begin = inside.copy()
        begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begin[block.starts] = True
        starts = np.flatnonzero(begin)
        # A unit ends where the next one of its word starts, or with the word.
        word = np.searchsorted(block.starts, starts, side="right") - 1
        ends = np.minimum(np.append(starts[1:], len(kind)), block.ends[word])
        return starts, ends, plain[word], np.where(inside, _LOWER[block.data], block.data)

    def of(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the block's units in a row, and the number of ids
        before each of its documents (and after the last)."""
        starts, ends, plain, data = self.units(block)
        distinct, at, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > CACHED_UNITS:
            self._forget()
        self.block += 1
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            spans = zip(starts[at[new]].tolist(), ends[at[new]].tolist())
            self._learn(place[new], distinct[new], [data[a:b].tobytes().decode("utf-8", "replace") for a, b in spans], plain[at[new]])
            place = np.searchsorted(self.keys, distinct)
        self.met[place] = self.block
        first, count = self.first[place][back], self.count[place].astype(np.int64)[back]
        before = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(count, out=before[1:])
        return self.ids[ranges(first, count)], before[np.searchsorted(starts, block.offsets)]


@functools.lru_cache(maxsize=2)
def _unit_tokens(path: str) -> UnitTokens:
    return UnitTokens(path)


def documents_ids(block: Block, units: UnitTokens, end_id: int) -> Iterator[bytes]:
    """Each document's ids, the end id last."""
    ids, offsets = units.of(block)
    last = array("I", [end_id]).tobytes()
    for start, end in itertools.pairwise(offsets.tolist()):
        yield ids[start:end].tobytes() + last


def _cut(pieces: list[Piece], n: int) -> tuple[list[Piece], list[Piece]]:
    """The first n ids of a run of pieces, and the rest."""
    head, left = [], n
    for k, (doc, start, ids, total) in enumerate(pieces):
        size = len(ids) >> 2
        if size > left:
            parts = [(doc, start, ids[:4 * left], total)] if left else []
            return head + parts, [(doc, start + left, ids[4 * left:], total), *pieces[k + 1:]]
        head.append(pieces[k])
        left -= size
    return head, []


class Packer:
    """Open windows as [used, pieces]; ``add`` returns the sequences that it
    completes or emits."""

    def __init__(self, length: int, windows: int, min_cut: int):
        self.length, self.windows, self.min_cut = length, windows, max(1, min_cut)
        self.open: list[list] = []

    def add(self, pieces: list[Piece], n: int) -> list[list[Piece]]:
        out = []
        while n >= self.length:
            whole, pieces = _cut(pieces, self.length)
            out.append(whole)
            n -= self.length
        if not n:
            return out
        room = self.length - n
        best = max((w for w in self.open if w[0] <= room), key=lambda w: w[0], default=None)
        if best is not None:
            best[0] += n
            best[1] += pieces
            if best[0] == self.length:
                out.append(self._close(best))
            return out
        if len(self.open) >= self.windows:
            fullest = max(self.open, key=lambda w: w[0])
            gap = self.length - fullest[0]
            if gap >= self.min_cut and n - gap >= self.min_cut:
                head, pieces = _cut(pieces, gap)
                fullest[1] += head
                n -= gap
            out.append(self._close(fullest))
        self.open.append([n, list(pieces)])
        return out

    def _close(self, window: list) -> list[Piece]:
        self.open = [w for w in self.open if w is not window]
        return window[1]

    def finish(self) -> list[list[Piece]]:
        """All that is open, without padding: the emptiest windows fill the
        fullest ones, and what remains is cut at powers of two."""
        windows = sorted(self.open, key=lambda w: -w[0])
        self.open, out = [], []
        while len(windows) > 1:
            fullest, emptiest = windows[0], windows[-1]
            n = min(self.length - fullest[0], emptiest[0])
            head, emptiest[1] = _cut(emptiest[1], n)
            fullest[1] += head
            fullest[0] += n
            emptiest[0] -= n
            if not emptiest[0]:
                windows.pop()
            if fullest[0] == self.length:
                out.append(windows.pop(0)[1])
        for used, pieces in windows:
            while used:
                part = 1 << (used.bit_length() - 1)
                head, pieces = _cut(pieces, part)
                out.append(head)
                used -= part
        return out


class _Rows:
    """Pieces as columns, handed out in batches."""

    def __init__(self, schema: pa.Schema, round_: int, task: int):
        self.schema, self.task = schema, task
        self.base = ((round_ << TASK_BITS) + task) << COUNT_BITS
        self.count = 0
        self._clear()

    def _clear(self):
        self.rows: list[tuple] = []
        self.bytes = 0

    def sequence(self, pieces: list[Piece], window: int | None = None) -> None:
        """A finished sequence, or an open window (its number given)."""
        number = None if window is not None else self.base + self.count
        self.count += window is None
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids) >> 2, total, number, offset, ids, self.task, window))
            offset += len(ids) >> 2
            self.bytes += len(ids) + 64

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in self.schema]
        self._clear()
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def _schemas(docs: DataFrame) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([docs.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in (
        "start", "length", "doc_tokens", "sequence_id", "offset")] + [
        T.StructField("ids", T.BinaryType()), T.StructField("task", T.LongType()), T.StructField("window", T.LongType())])
    return schema, to_arrow_schema(schema)


def _pack_partitions(docs: DataFrame, path: str, end_id: int, length: int, windows: int, min_cut: int) -> DataFrame:
    schema, arrow = _schemas(docs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, packer = _unit_tokens(path), Packer(length, windows, min_cut)
        rows = _Rows(arrow, 0, TaskContext.get().partitionId())
        for batch in batches:
            for block in blocks(batch.column(1)):
                docs_ = batch.column(0).slice(block.first, len(block)).to_pylist()
                for doc, ids in zip(docs_, documents_ids(block, units, end_id)):
                    n = len(ids) >> 2
                    for sequence in packer.add([(doc, 0, ids, n)], n):
                        rows.sequence(sequence)
                    if rows.bytes > BATCH_BYTES:
                        yield rows.batch()
        for k, (_, pieces) in enumerate(packer.open):
            rows.sequence(pieces, window=k)
        yield rows.batch()

    return docs.select("doc_id", "text").mapInArrow(pack, schema)


def _merge(left: DataFrame, round_: int, last: bool, length: int, windows: int, min_cut: int) -> DataFrame:
    """Open windows of up to FAN tasks packed by one."""
    schema, arrow = _schemas(left)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        packer, rows = Packer(length, windows, min_cut), _Rows(arrow, round_, key[0].as_py())
        ordered = table.sort_by([("task", "ascending"), ("window", "ascending"), ("offset", "ascending")])
        bundle, size, at = [], 0, None

        def place():
            for sequence in packer.add(bundle, size) if size else ():
                rows.sequence(sequence)

        for task, window, doc, start, ids, total in zip(*(ordered.column(c).to_pylist() for c in (
                "task", "window", "doc_id", "start", "ids", "doc_tokens"))):
            if (task, window) != at:
                place()
                bundle, size, at = [], 0, (task, window)
            bundle.append((doc, start, ids, total))
            size += len(ids) >> 2
        place()
        if last:
            for sequence in packer.finish():
                rows.sequence(sequence)
        for k, (_, pieces) in enumerate(packer.open):
            rows.sequence(pieces, window=k)
        return pa.Table.from_batches([rows.batch()])

    grouped = left.withColumn("group", F.expr(f"task div {FAN}"))
    return grouped.groupBy("group").applyInArrow(merge, schema)


def packed(docs: DataFrame, length: int = LENGTH, windows: int = WINDOWS, min_cut: int = MIN_CUT,
           end_id: int = END_ID, tokenizer_file: str | None = None) -> DataFrame:
    """The pieces of all documents, see the module's text. ``length`` is a
    power of two."""
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    path = tokenizer_file or tokenizer_path()
    table = written(_pack_partitions(docs, path, end_id, length, windows, min_cut), "pack-partitions")
    tables, round_ = [table], 0
    most = table.where("window IS NOT NULL").agg(F.max("task")).first()[0]
    while most is not None:
        round_ += 1
        groups = most // FAN + 1
        left = tables[-1].where("window IS NOT NULL")
        tables.append(written(_merge(left, round_, groups == 1, length, windows, min_cut), f"pack-merge-{round_}"))
        most = None if groups == 1 else groups - 1
    out = None
    for t in tables:
        done = t.where("window IS NULL").drop("task", "window")
        out = done if out is None else out.unionByName(done)
    return out

"""Words of whole texts as numpy arrays, for the Arrow-batched operators.

A word is a maximal run of bytes other than space and 0x09-0x0D, which on
UTF-8 text is the pattern ``[^\\x20\\x09-\\x0D]+``. Words are found and hashed
for a whole block of documents at once; no Python object is made per word.
Blocks hold at most ``BLOCK_BYTES`` of text unless one document alone is
longer, so memory follows the longest document, not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _M2
    x = (x ^ (x >> _U(27))) * _M3
    return x ^ (x >> _U(31))


@dataclass
class Block:
    """Consecutive documents: ``first`` is the position of the first one in
    its batch, ``data`` their bytes (8 padding bytes follow), ``offsets`` the
    byte offsets of the documents, ``starts``/``ends`` of the words, and
    ``word_offsets`` the index of each document's first word (n + 1 long)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_offsets)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.n_words)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return hash_spans(self.data, self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def span(self, first_word: int, last_word: int) -> bytes:
        """Bytes from the start of one word to the end of a later one."""
        return self.data[self.starts[first_word]:self.ends[last_word]].tobytes()


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash ``data[starts[i]:ends[i]]`` eight bytes at a time; ``data`` needs
    at least eight bytes of padding."""
    wide = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    left = ends - starts
    h = mix64(left.astype(np.uint64) * _M1 + _M3)
    at, live = starts, None
    while True:
        part = wide[at] & _KEEP[np.minimum(left, 8)]
        if live is None:
            h = mix64(h ^ (part * _M1 + _M2))
        else:
            h[live] = mix64(h[live] ^ (part * _M1 + _M2))
        more = np.flatnonzero(left > 8)
        if not len(more):
            return h
        live = more if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8


def _block(first: int, data: np.ndarray, offsets: np.ndarray) -> Block:
    lo, hi = offsets[0], offsets[-1]
    offsets = offsets - lo
    body = np.empty(hi - lo + 8, dtype=np.uint8)
    body[:hi - lo] = data[lo:hi]
    body[hi - lo:] = 0x20
    word = ~_SPACE[body[:hi - lo]]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    # A document's edge also ends a word.
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < hi - lo)]
    begin[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts = np.flatnonzero(begin)
    return Block(first, body, offsets, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES, max_docs: int | None = None) -> Iterator[Block]:
    """Blocks of the documents of one Arrow string column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    ofs = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ofs, ofs[i] + limit, side="right")) - 1)
        j = j if max_docs is None else min(j, i + max_docs)
        yield _block(i, data, ofs[i:j + 1])
        i = j


def gram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each word (length: words - n + 1)."""
    m = len(word_hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        h = (h + word_hashes[k:k + m]) * _M1
        h ^= h >> _U(29)
    return mix64(h)


def gram_starts(word_offsets: np.ndarray, n: int) -> np.ndarray:
    """Word indexes at which n consecutive words of one document start."""
    counts = np.maximum(np.diff(word_offsets) - n + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(word_offsets[:-1] - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift


def per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[offsets])


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + count[i] - 1 of all i, in a row."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)


def equal_to_other(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the keys that occur again, and of those that aren't the first
    of their kind (by position)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    later[order[1:][same]] = True
    return again, later


def duplicate_lines(block: Block) -> np.ndarray:
    """Per document: lines with a word that are equal to an earlier line."""
    body = block.data[:block.offsets[-1]]
    cuts = np.flatnonzero(body == 0x0A)
    starts = np.unique(np.concatenate([block.offsets[:-1], cuts + 1]))
    starts = starts[starts < len(body)]
    # A line ends at its line feed or with its document.
    ends = np.minimum(np.append(starts[1:], len(body)), len(body))
    ends = ends - (body[ends - 1] == 0x0A) if len(starts) else ends
    has_word = np.searchsorted(block.starts, ends) > np.searchsorted(block.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    doc = np.searchsorted(block.offsets, starts, side="right") - 1
    keys = mix64(hash_spans(block.data, starts, ends) + doc.astype(np.uint64) * _M1)
    return np.bincount(doc[equal_to_other(keys)[1]], minlength=len(block))


def repeat_words(block: Block, hashes: np.ndarray, window: int) -> np.ndarray:
    """Per document: words in windows that are found twice or more in it."""
    starts = gram_starts(block.word_offsets, window)
    doc = block.doc_of_word()[starts].astype(np.uint64)
    again, _ = equal_to_other(mix64(gram_hashes(hashes, window)[starts] + doc * _M1)) if len(starts) else (starts, None)
    covered = np.zeros(len(hashes), dtype=bool)
    if len(starts):
        for k in range(window):
            covered[starts[again] + k] = True
    return per_doc(covered, block.word_offsets)

"""Token counts of a unigram tokenizer, without making tokens.

Each word (a run of characters other than space and 0x09-0x0D, with the word
mark U+2581 before it) is segmented into vocabulary pieces with the highest
sum of scores. One Aho-Corasick pass over the word lists the pieces that end
at each character; dynamic programming keeps, per end, only the best score and
the number of tokens on that path.

Tie rules, as in the tokenizer: of paths with equal scores the one whose last
piece starts first stays. A character that is no piece by itself may be taken
as unknown, at the vocabulary's lowest score less 10; it becomes one token per
UTF-8 byte if the vocabulary has byte pieces, else one token per run of
unknown characters.

The vocabulary is a public model file's pieces and scores
(``<vocab_dir>/piece_bpe_32k.model``), read as unigram scores. Each different
word is segmented once per worker.

Defined results: null or empty text has no tokens and score 0; repeated rows
give repeated results; texts are counted whole, memory follows the longest
one; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from monthly_facts.llm.words import Block, blocks

VOCAB_DIR = "/opt/tokenizers"
WORD_MARK = "▁"
# Fixed value: what an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 200_000


def vocabulary(vocab_dir: str = VOCAB_DIR) -> tuple[list[tuple[str, float]], bool]:
    """(piece, score) of all ordinary pieces, and whether there are byte
    pieces to fall back to."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=f"{vocab_dir}/piece_bpe_32k.model")
    ids = range(model.get_piece_size())
    ordinary = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in ordinary], any(model.is_byte(i) for i in ids)


class Counter:
    """Counts tokens of words; ``count(word)`` is (tokens, unknown characters,
    best score)."""

    def __init__(self, pieces: Sequence[tuple[str, float]], byte_fallback: bool, lowest: float | None = None):
        self.byte_fallback = byte_fallback
        self.unknown = (min(s for _, s in pieces) if lowest is None else lowest) - UNKNOWN_PENALTY
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def count(self, word: str) -> tuple[int, int, float]:
        n = len(word)
        score: list[float | None] = [0.0] + [None] * n
        tokens, unknown, in_unknown = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(word)
        upcoming = next(matches, None)
        for end in range(1, n + 1):
            best = None
            # Matches at one end come longest first: the earliest start first,
            # and only a higher score replaces it.
            while upcoming is not None and upcoming[0] == end - 1:
                length, s = upcoming[1]
                s += score[end - length]
                if best is None or s > best:
                    best, start, known = s, end - length, True
                upcoming = next(matches, None)
            if word[end - 1] not in self.single:
                s = self.unknown + score[end - 1]
                if best is None or s > best:
                    best, start, known = s, end - 1, False
            score[end], unknown[end], in_unknown[end] = best, unknown[start] + (not known), not known
            if known:
                tokens[end] = tokens[start] + 1
            elif self.byte_fallback:
                tokens[end] = tokens[start] + len(word[start].encode("utf-8", "replace"))
            else:
                tokens[end] = tokens[start] + (not in_unknown[start])
        return tokens[n], unknown[n], score[n]


class _Memo:
    """Results of words, remembered by the words' hashes."""

    def __init__(self, counter: Counter):
        self.counter = counter
        self.clear()

    def clear(self):
        self.rows: dict[int, int] = {}
        self.values = np.zeros((1 << 14, 3))

    def of(self, block: Block) -> np.ndarray:
        """Per word of the block: tokens, unknown characters, score."""
        if len(self.rows) > CACHED_WORDS:
            self.clear()
        distinct, at, back = np.unique(block.hashes(), return_index=True, return_inverse=True)
        rows = np.array([self.rows.get(h, -1) for h in distinct.tolist()], dtype=np.int64)
        new = np.flatnonzero(rows < 0)
        n = len(self.rows)
        while n + len(new) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        for k, (h, w) in enumerate(zip(distinct[new].tolist(), at[new].tolist()), start=n):
            self.values[k] = self.counter.count(WORD_MARK + block.span(w, w).decode("utf-8", "replace"))
            self.rows[h] = k
        rows[new] = np.arange(n, n + len(new))
        return self.values[rows[back]]


@functools.lru_cache(maxsize=2)
def _memo(vocab_dir: str) -> _Memo:
    return _Memo(Counter(*vocabulary(vocab_dir)))


def counted(docs: DataFrame, vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """doc_id, n_tokens, n_unknown (unknown characters), score."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_unknown", T.LongType()), T.StructField("score", T.DoubleType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(vocab_dir)
        for batch in batches:
            for block in blocks(batch.column(1)):
                per_word = memo.of(block)
                doc = block.doc_of_word()
                sums = [np.bincount(doc, weights=per_word[:, k], minlength=len(block)) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(block)), pa.array(sums[0].astype(np.int64)),
                     pa.array(sums[1].astype(np.int64)), pa.array(sums[2].astype(np.float64))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(count, schema)

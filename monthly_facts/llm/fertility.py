"""Quality rules by tokenizer fertility.

Words of the whole text are tokenized by public vocabularies: a piece
vocabulary with byte fallback (``<vocab_dir>/piece_bpe_32k.model``) and a
byte-level one (``<vocab_dir>/byte_bpe_50k.tiktoken``). Neither joins
characters across white space, so a text's tokens are the tokens of its
words, and each different word is tokenized about once per task. Per document:

* ``chars_per_token``  code points in words per piece,
* ``chars_per_byte_token``  the same for the byte-level vocabulary,
* ``byte_share``  part of the pieces that are single fallback bytes,
* ``entropy``  bits per piece of the document's own piece frequencies,
  divided by the most it could be: log2 of the number of pieces or of the
  vocabulary, whichever is less.

A document is kept if the base rules pass and all four lie in the band of its
language; for a language without a band, in the band of the script that most
of its letters belong to.

The base counts (words, characters, symbols, repeated lines, words in
repeated 3-word windows) come from the same pass. Lines and windows are
compared by 64-bit hashes within one document.

Defined results: null or empty text has no words, all counts are 0, the
measures are null and the base rules fail; a null language uses the script's
band; repeated rows give repeated results; a text is never cut, memory
follows the longest one; an empty table gives an empty result; other columns
are carried along unread.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthly_facts.llm.tables import OWN
from monthly_facts.llm.words import Block, blocks, duplicate_lines, per_doc, ranges, repeat_words

VOCAB_DIR = "/opt/tokenizers"
# Fixed value: the pre-tokenizer pattern that belongs to the byte-level ranks.
BYTE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_WORDS = 200_000

MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"

# Lowest and highest chars_per_token, the same for chars_per_byte_token,
# highest byte_share, lowest entropy. A band is for clean prose of that
# language; its width leaves room for names, numbers and code.
BANDS = {
    "de": (1.95, 8.0, 1.75, 8.0, 0.2, 0.3),
    "en": (1.95, 8.0, 1.90, 8.0, 0.2, 0.3),
    "es": (1.75, 8.0, 1.60, 8.0, 0.2, 0.3),
    "fr": (1.75, 8.0, 1.65, 8.0, 0.2, 0.3),
}
SCRIPT_BANDS = {
    "latin": (1.5, 10.0, 1.3, 10.0, 0.3, 0.3),
    "cyrillic": (1.0, 10.0, 0.6, 10.0, 0.5, 0.3),
    "han": (0.3, 5.0, 0.3, 5.0, 0.95, 0.25),
    "other": (0.2, 10.0, 0.2, 10.0, 0.95, 0.25),
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["chars_per_token", "chars_per_byte_token", "byte_share", "entropy"]


class _Vocabulary:
    """Token ids of words, remembered by the words' hashes."""

    def __init__(self, encode, is_byte: np.ndarray):
        self.encode, self.is_byte = encode, is_byte
        self.clear()

    def clear(self):
        self.ids: dict[int, int] = {}
        self.tokens = np.zeros(1 << 16, dtype=np.int32)
        self.offsets = np.zeros(1 << 14, dtype=np.int64)

    def of(self, block: Block, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first token, number of tokens) of each word of the block, into
        ``self.tokens``."""
        if len(self.ids) > CACHED_WORDS:
            self.clear()
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        ids = self.ids
        known = np.array([ids.get(h, -1) for h in distinct.tolist()], dtype=np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            words = [block.span(w, w).decode("utf-8", "replace") for w in at[new].tolist()]
            found = self.encode(words)
            n = len(ids)
            known[new] = np.arange(n, n + len(new))
            ids.update(zip(distinct[new].tolist(), range(n, n + len(new))))
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ends = self.offsets[n] + np.cumsum(lengths)
            while n + len(new) + 1 > len(self.offsets):
                self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
            self.offsets[n + 1:n + 1 + len(new)] = ends
            while len(ends) and ends[-1] > len(self.tokens):
                self.tokens = np.concatenate([self.tokens, np.zeros_like(self.tokens)])
            self.tokens[self.offsets[n]:ends[-1]] = np.fromiter(
                (t for x in found for t in x), dtype=np.int32, count=int(lengths.sum()))
        first = self.offsets[known]
        return first[back], (self.offsets[known + 1] - first)[back]


@functools.lru_cache(maxsize=2)
def _vocabularies(vocab_dir: str) -> tuple[_Vocabulary, _Vocabulary]:
    import sentencepiece
    import tiktoken

    piece = sentencepiece.SentencePieceProcessor(model_file=f"{vocab_dir}/piece_bpe_32k.model")
    is_byte = np.array([piece.is_byte(i) for i in range(piece.get_piece_size())])
    with open(f"{vocab_dir}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    byte = tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return (_Vocabulary(lambda words: piece.encode(words, num_threads=1), is_byte),
            _Vocabulary(lambda words: [byte.encode_ordinary(" " + w) for w in words], np.zeros(0, dtype=bool)))


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def _entropy(tokens: np.ndarray, n_tokens: np.ndarray, size: int) -> np.ndarray:
    """Bits per token of each document's token frequencies, over the most that
    so many tokens of a vocabulary of ``size`` could have."""
    doc = np.repeat(np.arange(len(n_tokens)), n_tokens)
    keys = np.sort(doc * size + tokens)
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, dtype=np.int64)
    count = np.diff(edges)
    sums = np.bincount(keys[edges[:-1]] // size, weights=count * np.log2(count), minlength=len(n_tokens)) if len(keys) else np.zeros(len(n_tokens))
    n = np.maximum(n_tokens, 2)
    return (np.log2(n) - sums / n) / np.log2(np.minimum(n, size))


def measure_block(block: Block, vocab_dir: str) -> dict[str, np.ndarray]:
    hashes = block.hashes()
    body = block.data[:block.offsets[-1]]
    piece, byte = _vocabularies(vocab_dir)
    chars = np.searchsorted(block.starts, block.offsets)
    in_word = np.zeros(len(body) + 1, dtype=np.int8)
    in_word[block.starts] += 1
    in_word[block.ends] -= 1
    lead = (np.cumsum(in_word[:-1], dtype=np.int8) > 0) & ((body & 0xC0) != 0x80)
    out = {"n_words": np.diff(chars), "word_chars": per_doc(lead, block.offsets),
           "n_symbols": per_doc(_SYMBOL[body], block.offsets),
           "n_dup_lines": duplicate_lines(block), "n_repeat_words": repeat_words(block, hashes, WINDOW)}
    first, count = piece.of(block, hashes)
    tokens = piece.tokens[ranges(first, count)]
    n = per_doc(count, block.word_offsets)
    token_offsets = np.concatenate([[0], np.cumsum(n)])
    n_byte = per_doc(byte.of(block, hashes)[1], block.word_offsets)
    some = np.where(out["n_words"] > 0, 1.0, np.nan)
    out["chars_per_token"] = out["word_chars"] / np.maximum(n, 1) * some
    out["chars_per_byte_token"] = out["word_chars"] / np.maximum(n_byte, 1) * some
    out["byte_share"] = per_doc(piece.is_byte[tokens], token_offsets) / np.maximum(n, 1) * some
    out["entropy"] = _entropy(tokens, n, len(piece.is_byte)) * some
    return out


def measured(docs: DataFrame, vocab_dir: str = VOCAB_DIR, keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts and measures, their names prefixed; without
    ``keep_text`` the text itself does not come back."""
    carried = [c for c in docs.columns if keep_text or c != "text"]
    added = [T.StructField(OWN + c, T.LongType()) for c in COUNTS] + [T.StructField(OWN + c, T.DoubleType()) for c in MEASURES]
    schema = T.StructType([docs.schema[c] for c in carried] + added)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                names = batch.schema.names
                for block in blocks(batch.column(names.index("text"))):
                    part = batch.slice(block.first, len(block))
                    found = measure_block(block, vocab_dir)
                    arrays = [part.column(names.index(c)) for c in carried]
                    arrays += [pa.array(found[c], type=pa.int64()) for c in COUNTS]
                    arrays += [pa.array(found[c], type=pa.float64(), from_pandas=True) for c in MEASURES]
                    yield pa.RecordBatch.from_arrays(arrays, names=carried + [f.name for f in added])
        finally:
            # A worker lives on for other tasks, which need the memory.
            for vocabulary in _vocabularies(vocab_dir):
                vocabulary.clear()

    return docs.mapInArrow(measure, schema)


def script(text: str | Column) -> Column:
    """The script of most letters: latin, cyrillic, han or other."""
    counts = [(F.regexp_count(text, F.lit(p)), s) for p, s in (
        (r"\p{IsLatin}", "latin"), (r"\p{IsCyrillic}", "cyrillic"), (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]", "han"))]
    other = F.regexp_count(text, F.lit(r"\p{L}")) - sum(c for c, _ in counts)
    best = F.greatest(*[c for c, _ in counts], other)
    out = F.lit("other")
    for c, s in reversed(counts):
        out = F.when((c == best) & (c > 0), s).otherwise(out)
    return out


def _within(b: Sequence[float]) -> Column:
    chars, byte_chars, share, entropy = (F.col(OWN + m) for m in MEASURES)
    return chars.between(b[0], b[1]) & byte_chars.between(b[2], b[3]) & (share <= b[4]) & (entropy >= b[5])


def judged(docs: DataFrame, vocab_dir: str = VOCAB_DIR, bands: Mapping[str, Sequence[float]] | None = None,
           script_bands: Mapping[str, Sequence[float]] | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts, the measures, ``base_failed`` and ``kept``,
    all their names prefixed."""
    bands, script_bands = BANDS if bands is None else bands, SCRIPT_BANDS if script_bands is None else script_bands
    known = F.coalesce(F.lower("lang").isin(list(bands)), F.lit(False))
    # The script is looked up only where the language has no band.
    out = measured(docs.withColumn(OWN + "script", F.when(~known, script("text"))), vocab_dir, keep_text)
    ok = F.lit(True)
    for name, b in script_bands.items():
        ok = F.when(F.col(OWN + "script") == name, _within(b)).otherwise(ok)
    for name, b in bands.items():
        ok = F.when(F.lower("lang") == name, _within(b)).otherwise(ok)
    failed = (F.col(OWN + "n_words") < MIN_WORDS) | (
        F.col(OWN + "n_repeat_words") * 100 > F.col(OWN + "n_words") * REPEAT_PERCENT)
    return out.withColumn(OWN + "base_failed", failed).withColumn(
        OWN + "kept", ~failed & F.coalesce(ok, F.lit(False)))

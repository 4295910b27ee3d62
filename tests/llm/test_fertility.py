import collections
import math
import random
import re

import pytest

from monthly_facts.llm import fertility
from monthly_facts.llm.tables import OWN
from tests.llm.helpers import WORD, awkward_rows, collected, docs_frame, words


def base(text):
    ws, text = words(text), text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
        seen.add(line)
    grams = collections.Counter(tuple(ws[k:k + 3]) for k in range(len(ws) - 2))
    covered = {k + j for k in range(len(ws) - 2) if grams[tuple(ws[k:k + 3])] > 1 for j in range(3)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.fixture(scope="module")
def tokenizers():
    import base64

    import sentencepiece
    import tiktoken

    d = fertility.VOCAB_DIR
    piece = sentencepiece.SentencePieceProcessor(model_file=f"{d}/piece_bpe_32k.model")
    with open(f"{d}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return piece, tiktoken.Encoding("t", pat_str=fertility.BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def measures(text, piece, byte):
    ws = words(text)
    if not ws:
        return [None] * 4
    ids = [t for w in ws for t in piece.encode(w)]
    n, chars = len(ids), sum(map(len, ws))
    counts = collections.Counter(ids).values()
    bits = -sum(c / n * math.log2(c / n) for c in counts)
    other = sum(len(byte.encode_ordinary(" " + w)) for w in ws)
    most = math.log2(min(max(n, 2), piece.get_piece_size()))
    return [chars / n, chars / other, sum(piece.is_byte(t) for t in ids) / n, bits / most]


AWKWARD = awkward_rows() + [
    (200, "line one\nline one\n line one\n\n\nx\nx \nx\r\nx\r\n", "en", "a", 1),
    (201, "a a a\x0b\x0ca\x85b c\xa0d <<%$ #|&*", "en", "a", 1), (202, "\n\n", "en", "a", 1), (203, "\x1fA\x00B ☃☃ ☃", None, "a", 1),
    (204, "q" * 30000 + " end", "fr", "a", 1),
]


@pytest.mark.parametrize("clash", [False, True])
def test_counts_and_measures(spark, tokenizers, clash):
    docs = docs_frame(spark, AWKWARD, clash)
    out = collected(fertility.judged(docs))
    assert len(out) == len(AWKWARD)
    for r in out:
        want = base(r["text"])
        assert tuple(r[OWN + c] for c in fertility.COUNTS) == want
        assert r[OWN + "base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r[OWN + "kept"] and r[OWN + "base_failed"])
        got = [r[OWN + m] for m in fertility.MEASURES]
        for g, w in zip(got, measures(r["text"], *tokenizers)):
            assert (g is None) == (w is None) and (g is None or g == pytest.approx(w, abs=1e-9))


def test_long_text_and_cache_reset(spark, tokenizers, monkeypatch):
    import numpy as np

    from monthly_facts.llm.words import blocks
    import pyarrow as pa

    monkeypatch.setattr(fertility, "CACHED_WORDS", 10)
    fertility._vocabularies.cache_clear()
    texts = [r[1] for r in AWKWARD]
    got = [fertility.measure_block(b, fertility.VOCAB_DIR) for b in blocks(pa.array(texts), limit=2000)]
    fertility._vocabularies.cache_clear()
    chars = np.concatenate([g["chars_per_token"] for g in got])
    for c, t in zip(chars, texts):
        w = measures(t, *tokenizers)[0]
        assert math.isnan(c) if w is None else c == pytest.approx(w)


def test_bands(spark):
    vocabulary = ("the quick brown fox jumps over lazy dog while seven other animals watch from a quiet hill near old town where "
                  "people walked to market early in spring and carried bread water stories home before winter came again").split()
    prose = " ".join(random.Random(1).choices(vocabulary, k=200))
    noise = " ".join("xq7zk0vj" + str(k * 7919 % 100000) for k in range(200))
    rows = [(1, prose, "en", "a", 1), (2, noise, "en", "a", 1), (3, prose, "EN", "a", 1), (4, prose, None, "a", 1),
            (5, "это обычный русский текст про город и реку номер " * 3 + " ".join(f"слово{k} дом{k}" for k in range(60)), "ru", "a", 1),
            (6, " ".join(f"日本語{k}テキスト" for k in range(80)), "ja", "a", 1)]
    kept = {r["doc_id"]: r[OWN + "kept"] for r in collected(fertility.judged(docs_frame(spark, rows)))}
    assert kept == {1: True, 2: False, 3: True, 4: True, 5: True, 6: True}


def test_clean_labelled_documents_stay(spark):
    d = "/root/testdata/sf0.01/"
    out = fertility.judged(spark.read.parquet(d + "documents.parquet"))
    labels = spark.read.parquet(d + "labels.parquet")
    clean = collected(out.join(labels, "doc_id").where(f"quality = 1 AND NOT {OWN}base_failed"))
    assert len(clean) > 200 and sum(r[OWN + "kept"] for r in clean) >= 0.99 * len(clean)


def test_empty(spark):
    assert fertility.judged(docs_frame(spark, [])).collect() == []

import random

import numpy as np
import pyarrow as pa

from monthly_facts.llm import words as W
from tests.llm.helpers import awkward_rows, words


def test_words_of_blocks():
    texts = [r[1] for r in awkward_rows()] + ["", None, "  x", "x  ", "\x0b\x0c", "é", "a\x00b \x85"]
    for limit in (1, 500, 1 << 20):
        got = []
        for b in W.blocks(pa.array(texts), limit):
            for d in range(len(b)):
                got.append([b.span(k, k).decode() for k in range(b.word_offsets[d], b.word_offsets[d + 1])])
        assert got == [words(t) for t in texts]


def test_slices_and_chunks():
    texts = pa.array(["a b", None, "c", "d e f"])
    assert [b.n_words.tolist() for b in W.blocks(texts.slice(1, 3))] == [[0, 1, 3]]
    assert [b.n_words.tolist() for b in W.blocks(pa.chunked_array([texts, texts.slice(2)]))] == [[2, 0, 1, 3, 1, 3]]
    assert list(W.blocks(pa.array([], pa.string()))) == []


def test_hashes_depend_on_the_word_only():
    rng = random.Random(1)
    ws = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    (block,) = W.blocks(pa.array([" ".join(ws)]))
    seen = {}
    for w, h in zip(ws, block.hashes().tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_stay_in_documents():
    (block,) = W.blocks(pa.array(["a b c", "d", "e f", ""]))
    assert W.gram_starts(block.word_offsets, 2).tolist() == [0, 1, 4]
    g = W.gram_hashes(block.hashes(), 2)
    assert len(g) == 5 and len(np.unique(g)) == 5

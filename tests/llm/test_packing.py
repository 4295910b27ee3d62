import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from monthly_facts.llm import packing as P
from monthly_facts.llm.words import blocks
from tests.llm.helpers import awkward_rows, collected, docs_frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END_ID]


def check(out, rows, tokenizer, length):
    """Every id of every row in one piece, sequences gapless and not too long;
    returns padding."""
    want, got = defaultdict(list), defaultdict(list)
    for r in rows:
        want[r[0]].append(ids_of(tokenizer, r[1]))
    sequences = defaultdict(list)
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        got[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(got) == set(want)
    for doc, texts in want.items():
        # Rows may share an id: all their pieces, as cuts of those texts.
        assert sum(len(i) for _, i, _ in got[doc]) == sum(map(len, texts))
        for start, ids, total in got[doc]:
            assert any(len(t) == total and t[start:start + len(ids)] == ids for t in texts)
        if len(texts) == 1:
            assert [x for _, ids, _ in sorted(got[doc]) for x in ids] == texts[0]
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


@pytest.mark.parametrize("length,windows,min_cut", [(4096, 32, 16), (64, 3, 4), (256, 1, 1)])
def test_every_id_once(spark, tokenizer, length, windows, min_cut):
    rows = awkward_rows()
    docs = docs_frame(spark, rows, clash=True).repartition(7)
    out = collected(P.packed(docs, length, windows, min_cut))
    padding = check(out, rows, tokenizer, length)
    n = sum(r["length"] for r in out)
    # A sequence is emitted with a gap under min_cut, or before a short rest.
    assert padding <= n * min_cut / length * 2 if min_cut > 1 else padding == 0


def test_many_partitions_merge_in_rounds(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "FAN", 3)
    rows = [(i, "word " * (i % 50 + 1), "en", "a", 1) for i in range(400)]
    out = collected(P.packed(docs_frame(spark, rows).repartition(40), 512, 4))
    assert check(out, rows, tokenizer, 512) < 512
    assert len({r["sequence_id"] >> 56 for r in out}) > 2


def test_reruns_agree(spark, workdir):
    docs_frame(spark, awkward_rows()).repartition(5).write.parquet(workdir + "/d")
    docs = spark.read.parquet(workdir + "/d")
    once, again = (sorted(map(str, P.packed(docs, 128, 4).collect())) for _ in range(2))
    assert once == again


def test_empty(spark):
    assert P.packed(docs_frame(spark, [])).collect() == []
    only = collected(P.packed(docs_frame(spark, [(1, None, None, None, None), (None, "", None, None, None)])))
    assert sorted((r["doc_id"] is None, r["length"], r["doc_tokens"]) for r in only) == [(False, 1, 1), (True, 1, 1)]


def test_best_fit_and_emission():
    packer = P.Packer(10, 2, 2)
    doc = lambda n: ([("d", 0, bytes(4 * n), n)], n)
    assert packer.add(*doc(6)) == [] and packer.add(*doc(8)) == []
    assert packer.add(*doc(1)) == [] and sorted(w[0] for w in packer.open) == [6, 9]   # the fullest that has room
    done = packer.add(*doc(5))                                                        # none has: the fullest goes, gap 1
    assert [sum(len(p[2]) for p in s) // 4 for s in done] == [9] and sorted(w[0] for w in packer.open) == [5, 6]
    done = packer.add(*doc(8))                                                        # a cut of 4 and 4
    assert [sum(len(p[2]) for p in s) // 4 for s in done] == [10] and sorted(w[0] for w in packer.open) == [4, 5]
    assert [sum(len(p[2]) for p in s) // 4 for s in packer.finish()] == [8, 1]
    assert len(P.Packer(10, 2, 2).add(*doc(30))) == 3
    assert len(packer.open) == 0


def test_ids_are_those_of_the_whole_text(tokenizer):
    """Odd signs, contractions, special tokens, marks and white space."""
    rng = random.Random(5)
    parts = ["a", "B", "z", "'s", "'S", "'re", "'", '"', "9", "10", ".", "<|endoftext|>", "<|ENDOFTEXT|>", "|", "é", "é", "́", "İ",
             "ß", "Σ", " ", "\n", "\t", " ", "\u0085", "\x1c", "\x00", "\x01", "\x7f", "日", "👩‍👩‍👧", "ﬁ", "Ⅷ", "½", "th", "ing", "ǅ", "..",
             "-", "_", "$", "'LL", "'ve", "\r\n", "　", "don't", "﻿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["'" * 50, "x" * 5000, "\x01", "a \x01 b", " ".join("abc" * 3 for _ in range(3000))]
    units = P.UnitTokens(P.tokenizer_path())
    found = [np.frombuffer(ids, "<u4").tolist() for b in blocks(pa.array(texts), limit=5000) for ids in P.documents_ids(b, units, P.END_ID)]
    assert found == [ids_of(tokenizer, t) for t in texts]


def test_memory_of_units_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHED_UNITS", 50)
    units = P.UnitTokens(P.tokenizer_path())
    texts = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} été{i}" for i in range(2000)]
    found = [np.frombuffer(ids, "<u4").tolist() for b in blocks(pa.array(texts), limit=300) for ids in P.documents_ids(b, units, P.END_ID)]
    assert found == [ids_of(tokenizer, t) for t in texts]
    assert len(units.keys) < 300

import random

import pytest
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from monthly_facts.llm import unigram_count as U
from tests.llm.helpers import awkward_rows, collected, docs_frame


def reference(pieces, byte_fallback):
    """The tokenizer whose counts must be met."""
    vocab = [("<unk>", 0.0)] + ([(f"<0x{i:02X}>", 0.0) for i in range(256)] if byte_fallback else []) + list(pieces)
    t = Tokenizer(models.Unigram(vocab, 0, byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"),
        pre_tokenizers.Metaspace(replacement=U.WORD_MARK, prepend_scheme="always", split=False)])
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("clash", [False, True])
def test_counts_meet_the_tokenizer(spark, clash):
    rows = awkward_rows() + [(300, "☃x☃☃ y日本語\x00 \x85 \xa0 a b", "en", "a", 1), (301, "w" * 5000, "en", "a", 1)]
    count = reference(*U.vocabulary())
    out = {(r["doc_id"], r["n_tokens"]) for r in collected(U.counted(docs_frame(spark, rows, clash)))}
    assert out == {(r[0], count(r[1])) for r in rows}


def test_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    count = reference(*U.vocabulary())
    want = {r["doc_id"]: count(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in collected(U.counted(docs))} == want


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_ties_and_unknowns(byte_fallback):
    """Small vocabularies with whole-number scores: ties everywhere."""
    rng = random.Random(11)
    for _ in range(150):
        alphabet = "abcé"[:rng.randrange(1, 5)] + U.WORD_MARK
        pieces = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))): float(-rng.randrange(0, 4)) for _ in range(rng.randrange(1, 12))}
        pieces = sorted(pieces.items())
        count = reference(pieces, byte_fallback)
        # The reference's byte and unknown entries, all at 0, never lower the lowest score.
        counter = U.Counter(pieces, byte_fallback, lowest=min(0.0, min(s for _, s in pieces)))
        for _ in range(20):
            word = "".join(rng.choice("abcéx☃") for _ in range(rng.randrange(1, 12)))
            assert counter.count(U.WORD_MARK + word)[0] == count(word), (pieces, word)


def test_best_score_is_best():
    rng = random.Random(5)
    for _ in range(60):
        pieces = {c: float(-rng.randrange(1, 9)) for c in "ab" + U.WORD_MARK}
        pieces |= {"".join(rng.choice("ab") for _ in range(rng.randrange(2, 4))): float(-rng.randrange(1, 9)) for _ in range(5)}
        counter = U.Counter(sorted(pieces.items()), False)
        word = U.WORD_MARK + "".join(rng.choice("ab") for _ in range(8))

        def best(s):
            return 0.0 if not s else max(v + best(s[len(p):]) for p, v in pieces.items() if s.startswith(p))
        assert counter.count(word)[2] == best(word)


def test_empty(spark):
    assert U.counted(docs_frame(spark, [])).collect() == []

import random
import re

import pytest

from monthly_facts.llm import decontam
from tests.llm.helpers import awkward_rows, collected, docs_frame, prose


def grams(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, items):
    out = []
    for r in rows:
        held = grams(r[1])
        for i, text in items:
            asked = grams(text)
            if asked and len(asked & held) >= 0.8 * len(asked) - 1e-9:
                out.append((r[0], i, len(asked & held), len(asked)))
    return sorted(out, key=str)


def items_for(rng, n=25):
    return [(i, prose(rng, rng.choice([6, 12, 25, 50, 90]), 5000)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    items = items_for(rng)
    rows = awkward_rows(seed)
    for k in range(120):  # items with some words lost, inside other prose, other case and marks
        w = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = "lost"
        cut = w[rng.randrange(0, 4):len(w) - rng.randrange(0, 3)]
        text = prose(rng, rng.randrange(0, 400), 5000) + ". " + " ".join(cut).title().replace(" ", rng.choice([" ", ", ", "\n"])) + "! " + prose(rng, 20)
        rows.append((500 + k, text, "en", "a", 1))
    items += [(100, items[0][1]), (101, None), (102, " !! "), (103, "two words"), (None, items[1][1])]
    rows.append((900, "Two, WORDS!", "en", "a", 1))
    rows.append((901, "not only two words here", "en", "a", 1))
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, words string")
    want = brute(rows, items)
    assert len(want) > 40
    for clash in (False, True):
        docs = docs_frame(spark, rows, clash)
        got = collected(decontam.contaminated(docs, bench))
        assert sorted(((r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in got), key=str) == want
        clean = decontam.clean(docs, bench)
        assert clean.columns == docs.columns
        bad_texts = {r[1] for r in rows if grams(r[1]) and brute([r], items)}
        assert sorted(str((r["doc_id"], r["text"])) for r in collected(clean)) == sorted(str((r[0], r[1])) for r in rows if r[1] not in bad_texts)


def test_planted_passages(spark):
    d = "/root/testdata/sf0.001/"
    docs, bench = spark.read.parquet(d + "documents.parquet"), spark.read.parquet(d + "benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    got = collected(decontam.contaminated(docs, bench))
    assert sorted(((r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in got), key=str) == want and want


def test_empty(spark):
    docs, none = docs_frame(spark, awkward_rows()), docs_frame(spark, [])
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert decontam.contaminated(none, bench).collect() == []
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []
    assert decontam.clean(docs, bench.limit(0)).count() == docs.count()


def test_shared_boilerplate_makes_few_pairs(spark, monkeypatch):
    """300 items and 300 documents that share one sentence are not 90,000 pairs."""
    rng = random.Random(8)
    sentence = prose(rng, 15, 10**6)
    items = [(i, sentence + " " + prose(rng, 20, 10**6)) for i in range(300)]
    rows = [(i, prose(rng, 60, 10**6) + " " + sentence + " " + prose(rng, 60, 10**6), "en", "a", 1) for i in range(300)]
    rows += [(1000 + i, prose(rng, 30, 10**6) + " " + items[i][1], "en", "a", 1) for i in range(5)]
    seen, real = {}, decontam.written
    monkeypatch.setattr(decontam, "written", lambda df, name: seen.setdefault(name, real(df, name)))
    out = decontam.contaminated(docs_frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(1000 + i, i) for i in range(5)]
    assert seen["decontam-pairs"].count() < 100 and seen["decontam-candidates"].count() == 5


def test_items_made_of_boilerplate_are_found(spark):
    rng = random.Random(9)
    sentence = prose(rng, 15, 10**6)
    rows = [(i, prose(rng, 40, 10**6) + " " + (sentence if i % 2 else "") + " " + prose(rng, 40, 10**6), "en", "a", 1) for i in range(200)]
    items = [(1, sentence), (2, sentence + " but more"), (3, prose(rng, 30, 10**6))]
    out = decontam.contaminated(docs_frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in out), key=str) == brute(rows, items) and len(out) == 200

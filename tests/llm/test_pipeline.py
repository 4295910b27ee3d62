import collections
import random

import pytest

import corpus_pipeline
from monthly_facts.llm import sharding
from monthly_facts.llm.tables import OWN
from tests.llm import test_decontam, test_mixing, test_near_dedup
from tests.llm.helpers import awkward_rows, collected, docs_frame, prose, words


def english(rng, n):
    vocabulary = ("the quick brown fox jumps over lazy dog while seven other animals watch from a quiet hill near old town where "
                  "people walked to market early in spring and carried bread water stories home before winter came again").split()
    return " ".join(rng.choice(vocabulary) + (f"{rng.randrange(10**5)}" if rng.random() < 0.3 else "") for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = awkward_rows(4)
    items = [(k, english(rng, rng.choice([15, 30, 55]))) for k in range(12)]
    for i in range(100, 260):
        text = english(rng, rng.choice([20, 80, 150, 400]))
        if i % 7 == 0:
            text += "\n" + items[i % 12][1] + "\n" + english(rng, 30)
        rows.append((i, text, "en", rng.choice(["a", "a", "a", "b", "c", None]), len(text)))
        if i % 5 == 0:
            rows.append((i + 1000, test_near_dedup.edited(rng, text, rng.choice([0, 0.005, 0.3])), "en", "b", 1))
    d = str(tmp_path_factory.mktemp("corpus"))
    docs_frame(spark, rows, clash=True).repartition(3).write.parquet(d + "/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(d + "/benchmark.parquet")
    return d, rows, items


def kept_by_quality(spark, rows):
    from monthly_facts.llm import fertility

    out = collected(fertility.judged(docs_frame(spark, rows)))
    kept = collections.Counter((r["doc_id"], r["text"]) for r in out if r[OWN + "kept"])
    return [r for r in rows if (r[0], r[1]) in kept]


def test_stages_against_brute_force(spark, tables):
    d, rows, items = tables
    docs = spark.read.parquet(d + "/documents.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]

    docs = stage["quality"](spark, docs, d)
    good = kept_by_quality(spark, rows)
    assert docs.columns == columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in collected(docs)))) == sorted(str((r[0], r[1])) for r in good)
    assert 100 < len(good) < len(rows)

    docs = stage["near_dedup"](spark, docs, d)
    assert docs.columns == columns
    of = test_near_dedup.roots(good)
    lowest = {g: i for g, i in test_near_dedup.classes_of(good, of).items()}
    unique = {r[0]: r for r, g in zip(good, of) if r[0] == lowest[g]}
    assert sorted(r["doc_id"] for r in collected(docs)) == sorted(unique) and len(unique) < len(good) - 10

    docs = stage["decontamination"](spark, docs, d)
    assert docs.columns == columns
    leaks = {i for i, r in unique.items() if test_decontam.brute([r], items)}
    clean = [r for i, r in unique.items() if i not in leaks]
    assert leaks and sorted(r["doc_id"] for r in collected(docs)) == sorted(r[0] for r in clean)

    docs = stage["mixing"](spark, docs, d)
    assert docs.columns == columns
    sizes = collections.Counter()
    for r in clean:
        sizes[r[3]] += len(words(r[1]))
    want, taken = test_mixing.brute_targets(sizes), collections.Counter()
    for r in collected(docs):
        taken[r["source"]] += len(words(r["text"]))
    assert all(abs(taken[s] - want[s]) <= max(len(words(r[1])) for r in clean) for s in sizes)

    n = docs.count()
    out = stage["sharding"](spark, docs, d)
    assert out.count() == n and set(columns) <= set(out.columns)
    assert {r["shard_bytes"] <= sharding.SHARD_BYTES for r in collected(out)} == {True}


def test_run_and_rerun(spark, tables):
    d, rows, _ = tables
    first, again = collected(corpus_pipeline.run(spark, d)), collected(corpus_pipeline.run(spark, d))
    assert first and sorted(map(str, first)) == sorted(map(str, again))
    assert {r["doc_id"] for r in first} <= {r[0] for r in rows}


def test_empty_documents(spark, tmp_path):
    d = str(tmp_path)
    docs_frame(spark, []).write.parquet(d + "/documents.parquet")
    spark.createDataFrame([(1, prose(random.Random(1), 20))], "item_id bigint, text string").write.parquet(d + "/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).collect() == []

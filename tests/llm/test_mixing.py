from collections import defaultdict

import duckdb
import pytest

from monthly_facts.llm import mixing, queries
from tests.llm.helpers import awkward_rows, collected, docs_frame, words


def brute_targets(sizes, cycle=3, most=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % cycle + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        capped |= over


def op1(docs):
    m = mixing.mix(docs)
    return collected(m.selectExpr("doc_id", "source", "size", "source_size", "target", "size * copies AS taken"))


@pytest.mark.parametrize("clash", [False, True])
def test_targets_and_taken(spark, clash):
    rows = awkward_rows()
    out = op1(docs_frame(spark, rows, clash))
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = brute_targets(sizes)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in out) == sorted(
        (r[0] is None, r[0] or 0, len(words(r[1]))) for r in rows)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max(len(words(r[1])) for r in rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest
    assert sorted(map(str, op1(docs_frame(spark, rows, clash)))) == sorted(map(str, out))


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "a b c d e f g h i j", "en", "a", 0) for i in range(1000)] + [(2000, "a b c", "en", "b", 0), (2001, "a b", "en", "c", 0)]
    out = op1(docs_frame(spark, rows))
    by = {r["source"]: r["target"] for r in out}
    assert by["b"] == 9 and by["c"] == 6 and by["a"] == 10005 - 15
    assert all(r["taken"] == 3 * r["size"] for r in out if r["source"] != "a")
    assert abs(sum(r["taken"] for r in out if r["source"] == "a") - by["a"]) <= 5


def taken_by_source(out):
    taken, target = defaultdict(int), {}
    for r in out:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    return taken, target


def test_rows_of_one_hash(spark):
    """A source of equal rows, and one of one id with different texts, still
    come within a document of their targets."""
    rows = [(1, "a b c d e f g h i j", "en", "a", 0)] * 1000 + [(2, "x " * (i % 30 + 1) + str(i), "en", "b", 0) for i in range(700)]
    rows += [(i, "y " * 9, "en", "c", 0) for i in range(10, 403)]
    docs = docs_frame(spark, rows)
    out = op1(docs)
    taken, target = taken_by_source(out)
    assert all(abs(taken[s] - target[s]) <= 31 for s in target)
    assert abs(taken["a"] - target["a"]) <= 5
    mixed = collected(mixing.mixed_documents(docs))
    for s in target:
        assert sum(len(words(r["text"])) for r in mixed if r["source"] == s) == taken[s]
    assert sorted(map(str, op1(docs.repartition(5)))) == sorted(map(str, out))
    documents = docs.toPandas()  # noqa: F841
    want = duckdb.connect().execute(queries.OP1_SQL).fetchall()
    assert sorted(str((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])) for r in out) == sorted(map(str, want))


def test_budgets_are_nested(spark):
    docs = docs_frame(spark, [(i, "x " * (i % 40 + 1), "en", "ab"[i % 2], 0) for i in range(800)])
    out = collected(mixing.mix(docs, fractions=(0.2, 0.5, 1.0)))
    copies = defaultdict(dict)
    for r in out:
        copies[r["doc_id"]][r["budget"]] = r["copies"]
    assert all(c[0.2] <= c[0.5] <= c[1.0] for c in copies.values())
    for b in (0.2, 0.5, 1.0):
        goal = {r["source"]: r["target"] for r in out if r["budget"] == b}
        for s, t in goal.items():
            assert abs(sum(r["size"] * r["copies"] for r in out if r["budget"] == b and r["source"] == s) - t) <= 20


def test_mixed_documents_repeats_rows(spark):
    rows = awkward_rows()
    docs = docs_frame(spark, rows, clash=True)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = sum(r["taken"] for r in op1(docs))
    assert sum(len(words(r["text"])) for r in collected(out)) == want


def test_empty_tables(spark):
    docs = docs_frame(spark, [])
    assert op1(docs) == []
    assert mixing.mixed_documents(docs).collect() == []
    only_empty = docs_frame(spark, [(1, None, None, None, None), (2, " ", "en", "a", 1)])
    assert [(r["size"], r["target"], r["taken"]) for r in op1(only_empty)] == [(0, 0.0, 0)] * 2


def test_sql_agrees_on_awkward_rows(spark):
    docs = docs_frame(spark, awkward_rows())
    documents = docs.toPandas()  # noqa: F841
    want = duckdb.connect().execute(queries.OP1_SQL.replace(
        "FROM documents", "FROM (SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id, CAST(n_chars AS BIGINT) AS n_chars) FROM documents)")).fetchall()
    got = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in op1(docs)]
    assert sorted(map(str, got)) == sorted(map(str, want))

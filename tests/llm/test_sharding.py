from collections import defaultdict

import duckdb
import pytest

from monthly_facts.llm import sharding
from tests.llm.helpers import awkward_rows, collected, docs_frame


def check(out, rows, limit):
    assert len(out) == len(rows)
    held, n = defaultdict(int), defaultdict(int)
    for r in out:
        held[r["shard"]] += r["n_bytes"]
        n[r["shard"]] += 1
    for r in out:
        assert r["shard_bytes"] == held[r["shard"]]
        assert held[r["shard"]] <= limit or n[r["shard"]] == 1
    names = [s.partition("-")[0] for s in held]
    # Buckets are prefixes; none lies inside another.
    assert not any(a != b and b.startswith(a) for a in set(names) for b in set(names))


@pytest.mark.parametrize("limit", [500, 4000, 1 << 20])
def test_every_shard_fits(spark, limit):
    rows = awkward_rows()
    docs = docs_frame(spark, rows, clash=True)
    out = sharding.sharded(docs, limit)
    assert [c for c in docs.columns if c in out.columns] == docs.columns
    out = collected(out)
    check(out, rows, limit)
    assert sorted(str((r["doc_id"], r["text"])) for r in out) == sorted(str((r[0], r[1])) for r in rows)


def test_repeated_rows_are_paged(spark):
    rows = [(1, "x" * 100, "en", "a", 1)] * 500 + [(i, "y" * 50, "en", "b", 1) for i in range(2, 300)]
    check(collected(sharding.sharded(docs_frame(spark, rows), 1000)), rows, 1000)


def test_one_id_with_many_texts(spark):
    rows = [(1, f"{i:060d}", "en", "a", 1) for i in range(200)] + [(2, "s" * 60, "en", c, 1) for c in "abcde"]
    rows += [(3, "t" * 250, "en", "a", i) for i in range(3)] + [(4, "u" * 30, "en", "a", 1)] * 9
    out = collected(sharding.sharded(docs_frame(spark, rows), 100))
    check(out, rows, 100)
    # Several rows of one id share a shard where they fit.
    assert max(sum(r["shard"] == s for r in out) for s in {r["shard"] for r in out}) == 3
    check(collected(sharding.sharded(docs_frame(spark, rows), 1000)), rows, 1000)


def test_only_large_buckets_split(spark):
    rows = [(i, "z" * 100, "en", "a", 1) for i in range(400)]
    out = collected(sharding.sharded(docs_frame(spark, rows), 2000))
    held = {r["shard"]: r["shard_bytes"] for r in out}
    for s in held:  # a bucket's parent did not fit
        if len(s) > 1:
            assert sum(r["n_bytes"] for r in out if r["shard"].startswith(s[:-1])) > 2000


def test_many_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SPARE_BITS", 0)
    monkeypatch.setattr(sharding, "MAX_FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "DEEPER_BITS", 3)
    rows = awkward_rows()
    check(collected(sharding.sharded(docs_frame(spark, rows), 700)), rows, 700)


def test_empty(spark):
    assert sharding.sharded(docs_frame(spark, [])).collect() == []


@pytest.mark.parametrize("limit", [700, 5000])
def test_sql_agrees(spark, limit):
    rows = [(1001, f"{i:0{50 + i % 3}d}", "en", "a", 1) for i in range(150)] + [(1002, "x" * 90, "en", c, 1) for c in "abcdefghij"]
    docs = docs_frame(spark, awkward_rows() + [(1000, "same " * 50, "en", "a", 1)] * 7 + rows)
    documents = docs.toPandas()  # noqa: F841
    sql = sharding.sharding_sql(limit, "(SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM documents)")
    want = duckdb.connect().execute(sql).fetchall()
    got = sharding.sharded(docs.select("doc_id", "text"), limit).drop("text").select("doc_id", "n_bytes", "shard", "depth", "shard_bytes")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))

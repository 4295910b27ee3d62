import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from monthly_facts.llm import hard_negatives as H
from monthly_facts.llm import queries
from tests.llm.helpers import collected

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed=3, n=400, dims=24):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centres[0] if rng.random() < 0.4 else rng.choice(centres)   # one crowded place
        rows.append((i, [x + rng.gauss(0, 0.4) for x in c], 0 if rng.random() < 0.35 else rng.randrange(10)))
    v = rows[100][1]
    rows += [(1000, v, 1), (1001, v, 1), (1002, v, 2), (100, v, 2), (1003, v[:10], 1), (1004, [], 1)]   # ties, a shared id, short
    rows += [(1005, None, 1), (1006, v, None), (1007, [None, *v[1:]], 1), (1008, [math.nan, *v[1:]], 1), (1009, [math.inf, *v[1:]], 1)]
    rows += [(None, v, 2), (None, v, 1), rows[200], rows[200], (-700, v, 3)]
    return rows


def brute(rows, relabel=True):
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if relabel and i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, (i, q, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, r)), j is None, j or 0, j, other) for b, (j, r, other) in enumerate(kept) if b != a]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[4] == label][:5]:
            fits = [s for s in scored if s[4] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]]
            out += [(i, p[3], k + 1, s[3], -p[0], -s[0]) for k, s in enumerate(fits[:5])]
    return out


@pytest.mark.parametrize("block,at_once", [(8192, 256), (37, 3)])
def test_query(spark, workdir, monkeypatch, block, at_once):
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "ANCHORS_AT_ONCE", at_once)
    rows = vectors()
    spark.createDataFrame([(*r, 1, 2, "b") for r in rows], SCHEMA + ", row int, rb int, bands string").write.parquet(workdir + "/embeddings.parquet")
    got = [tuple(r) for r in queries.op13_hard_negatives(spark, workdir).collect()]
    want = brute(rows)
    assert len(want) > 20 and sorted(map(str, got)) == sorted(map(str, want))


def test_sql_agrees(spark, workdir):
    rows = [r for r in vectors() if r[1] is None or len(r[1]) == 24]   # SQL takes vectors of one length
    spark.createDataFrame(rows, SCHEMA).write.parquet(workdir + "/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{workdir}/embeddings.parquet/*.parquet')")
    names = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    assert sorted(map(str, con.execute(f"SELECT {names} FROM ({H.MINED_SQL})").fetchall())) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("dims,size", [(1, 3), (64, 200), (64, 10 ** 6), (1500, 10 ** 7), (5000, 2)])
def test_scores_are_exact(dims, size):
    rng = np.random.default_rng(dims)
    a, b = rng.integers(-size, size + 1, (7, dims)), rng.integers(-size, size + 1, (9, dims))
    a[0], b[0], b[1] = size, size, -size     # the extremes
    primes = H.primes_for(dims, dims * size * size)
    assert all(min(dims, H.PART) * (p // 2) ** 2 < H.EXACT for p in primes) and len(set(primes)) == len(primes)
    assert (H.scores(H.Residues(a, primes), H.Residues(b, primes)) == a @ b.T).all()


def test_bands_and_sizes(spark):
    rows = spark.createDataFrame(vectors(), SCHEMA)
    out = collected(H.mined(rows, F.col("vec_id") % 10 == 0, first=3, low=50, high=90))
    assert out and all(50 * r["positive_score"] <= 100 * r["negative_score"] <= 90 * r["positive_score"] for r in out)
    assert max(r["rank"] for r in out) == 3


def test_negative_positives_have_no_band(spark):
    rows = spark.createDataFrame([(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.9], 2), (3, [0.0], 2)], SCHEMA)
    assert H.mined(rows, F.col("vec_id") == 0).collect() == []
    rows = spark.createDataFrame([(0, [1.0], 1), (1, [0.0], 1), (2, [-0.9], 2), (3, [0.0], 2)], SCHEMA)
    assert [tuple(r) for r in H.mined(rows, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 3, 0, 0)]


def test_empty_and_too_large(spark):
    assert H.mined(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []
    assert H.mined(spark.createDataFrame([(0, None, 1)], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []
    assert H.mined(spark.createDataFrame([(0, [], 1), (1, [], 2)], SCHEMA), F.col("vec_id") == 0).collect() == []
    with pytest.raises(ValueError, match="too large"):
        H.mined(spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], SCHEMA), F.col("vec_id") == 0)

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from monthly_facts.llm import near_dedup as N
from monthly_facts.llm.words import blocks
from tests.llm.helpers import awkward_rows, collected, docs_frame, prose, words


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return collections.Counter([tuple(w)] if w else [])
    return collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def weighted(rows):
    """Shingle weights of every row, by the definition."""
    all_ = [shingles(r[1]) for r in rows]
    df = collections.Counter(s for c in all_ for s in c)
    idf = {s: 1 - math.log(min(max(n / len(rows), 1 / N.FLOOR), 1)) / math.log(N.FLOOR) for s, n in df.items()}
    return [{s: n * idf[s] for s, n in c.items()} for c in all_]


def similarity(a, b):
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return shared / ((sum(a.values()) + sum(b.values()) - shared) or 1)


def roots(rows, threshold=N.SIMILARITY):
    w = weighted(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or similarity(w[i], w[j]) >= threshold - 1e-9:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def classes_of(rows, of=None):
    """The lowest id of each class."""
    groups = collections.defaultdict(list)
    for r, g in zip(rows, of or roots(rows)):
        groups[g].append(r[0])
    return {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}


def brute(rows):
    of = roots(rows)
    ids = classes_of(rows, of)
    return sorted((str(r[0]), str(ids[g])) for r, g in zip(rows, of))


def edited(rng, text, share):
    return " ".join("e%d" % rng.randrange(10**6) if rng.random() < share else w for w in text.split())


def families(seed, n=25):
    rng = random.Random(seed)
    rows, i = [], 1000
    for _ in range(n):
        text = prose(rng, rng.choice([6, 15, 80, 300, 800]), 10**6)
        for _ in range(rng.randrange(1, 6)):
            rows.append((i, edited(rng, text, rng.choice([0, 0.002, 0.005, 0.02, 0.1, 0.3])), "en", "a", 1))
            i += 1
    rng.shuffle(rows)
    return rows


def run(docs):
    return sorted((str(r["doc_id"]), str(r["class_id"])) for r in collected(N.near_duplicates(docs)))


@pytest.mark.parametrize("seed,clash", [(1, True), (1, False), (2, True)])
def test_against_brute_force(spark, seed, clash):
    rows = awkward_rows(seed) + families(seed)
    want = brute(rows)
    assert sum(a != b for a, b in want) > 20
    docs = docs_frame(spark, rows, clash)
    assert run(docs.repartition(5)) == want
    kept = N.unique_documents(docs)
    assert kept.columns == docs.columns
    out = collected(kept)
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(c) for c in classes_of(rows).values())
    assert len(out) == len({(r["text"] or "") for r in out})


def test_large_group_and_chain(spark):
    rng = random.Random(7)
    text = prose(rng, 200, 10**6)
    rows = [(i, edited(rng, text, 0.004), "en", "a", 1) for i in range(300)]
    chain, words_ = [], prose(rng, 150, 10**6).split()
    for k in range(40):  # each is near the next, the ends are not alike
        words_ = list(words_)
        words_[(k * 3) % 150] = f"c{k}"
        chain.append((1000 + k, " ".join(words_), "en", "a", 1))
    got = dict(run(docs_frame(spark, rows + chain).repartition(6)))
    assert dict(brute(rows + chain)) == got
    assert {got[str(1000 + k)] for k in range(40)} == {"1000"}


def test_many_edited_copies_near_the_threshold(spark):
    """All share buckets, few are similar, each mostly to one other only."""
    rng = random.Random(12)
    text, rows = prose(rng, 200, 10**6), []
    for i in range(600):
        one = edited(rng, text, 0.06)
        rows += [(2 * i, one, "en", "a", 1), (2 * i + 1, edited(rng, one, rng.choice([0.01, 0.012, 0.015])), "en", "a", 1)]
    want = brute(rows)
    assert 200 < sum(a != b for a, b in want) < 1000
    assert run(docs_frame(spark, rows).repartition(6)) == want


def test_link_with_few_equal_samples_behind_other_hubs(spark):
    """A pair at 0.8 whose samples agree in less than 0.74 and that is, in
    each bucket it shares, behind a hub that is like neither of the two."""
    rng = random.Random(14)
    weights = N.Weights(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 2000)

    def sketched(texts):
        sigs = np.concatenate([N.samples(b, weights)[1] for b in blocks(pa.array(texts), max_docs=1000)])
        nodes = [r["h"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").selectExpr("i", "xxhash64(t) h").orderBy("i").collect()]
        return sigs, N.bands(sigs), nodes
    text = prose(rng, 200, 10**6)
    near = [t for t in (edited(rng, text, 0.02) for _ in range(3000)) if 0.8 <= similarity(shingles(text), shingles(t)) < 0.83]
    far = [edited(rng, text, 0.06) for _ in range(3000)]
    far = [t for t in far if similarity(shingles(text), shingles(t)) < 0.72]
    sigs, keys, nodes = sketched([text] + near)
    far_sigs, far_keys, far_nodes = sketched(far)
    found = None
    for k in np.argsort((sigs[1:] == sigs[0]).mean(axis=1)) + 1:
        shared = np.flatnonzero(keys[k] == keys[0])
        hubs = [next((j for j in np.flatnonzero(far_keys[:, b] == keys[0, b]) if far_nodes[j] < min(nodes[0], nodes[k])
                      and similarity(shingles(far[j]), shingles(near[k - 1])) < 0.72), None) for b in shared]
        if len(shared) and None not in hubs:
            found = k, sorted(set(hubs))
            break
    k, hubs = found
    assert (sigs[k] == sigs[0]).mean() < 0.74
    rows = [(i, t, "en", "a", 1) for i, t in enumerate([text, near[k - 1]] + [far[j] for j in hubs])]
    rows += [(100 + i, prose(rng, 6, 10**6), "en", "a", 1) for i in range(64 * len(rows) + 64)]
    got = dict(run(docs_frame(spark, rows)))
    assert got["0"] == got["1"] == "0" and got == dict(brute(rows))


def test_outlines_never_hide_a_pair():
    rng = random.Random(13)
    line = prose(rng, 6, 10**6)
    texts = [t for n in (3, 6, 40, 300, 4000) for t in [prose(rng, n, 10**6)]
             for t in (t, edited(rng, t, 0.02), edited(rng, t, 0.1), t + " " + t, " ".join([line] * n + [t]))]
    w = [shingles(t) for t in texts]
    df = collections.Counter(s for c in w for s in c)
    (block,) = blocks(pa.array(texts))
    doc, hashes, _ = N._shingles(block)
    weights = N.Weights(*np.unique(hashes, return_counts=True), len(texts))
    idf = {s: 1 - math.log(max(n / len(texts), 1 / N.FLOOR)) / math.log(N.FLOOR) for s, n in df.items()}
    w = [{s: n * idf[s] for s, n in c.items()} for c in w]
    _, weight, outline = N.outlines(block, weights)
    assert (outline == 65535).any()
    x, y = np.triu_indices(len(texts), 1)
    most = N.most_shared(weight, outline, x, y)
    true = np.array([similarity(w[a], w[b]) for a, b in zip(x, y)])
    assert (most >= true - 1e-9).all() and (most < true + 0.2).mean() > 0.5


def test_buckets_over_the_bound_split(spark, monkeypatch):
    monkeypatch.setattr(N, "MAX_BUCKET", 20)
    rows = families(5, 15)
    rng = random.Random(8)
    text = prose(rng, 300, 10**6)
    rows += [(5000 + i, edited(rng, text, rng.choice([0.001, 0.004, 0.01])), "en", "a", 1) for i in range(120)]
    assert run(docs_frame(spark, rows).repartition(4)) == brute(rows)


def repeated_lines(seed, n=12):
    """Pairs that share a line many times and differ in all other text, some
    of them enough for a link and some not."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        line, times = prose(rng, rng.choice([8, 50]), 10**6), 100
        own = len(line.split()) * times // (9 if i % 3 else 3)
        rows += [(10000 + 2 * i + k, "\n".join([line] * times + [prose(rng, own, 10**6)]), "en", "a", 1) for k in range(2)]
    return rows


def test_repeated_lines(spark):
    rows = repeated_lines(4)
    want = brute(rows)
    assert sum(a != b for a, b in want) == 8
    assert run(docs_frame(spark, rows).repartition(3)) == want


def test_samples_follow_uneven_weights():
    rng = random.Random(11)
    weights = N.Weights(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 2)
    for _ in range(5):
        line = prose(rng, 50, 10**6)
        texts = [" ".join([line] * 100 + [prose(rng, 400, 10**6)]) for _ in range(2)]
        (block,) = blocks(pa.array(texts))
        _, sig = N.samples(block, weights)
        assert abs((sig[0] == sig[1]).mean() - similarity(*map(shingles, texts))) < 0.13


def test_samples_estimate_similarity():
    rng = random.Random(3)
    text = prose(rng, 2000, 10**6)
    texts = [text] + [edited(rng, text, s) for s in (0.005, 0.02, 0.05, 0.1)]
    weights = N.Weights(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 5)
    (block,) = blocks(pa.array(texts))
    _, sig = N.samples(block, weights)
    w = [shingles(t) for t in texts]
    for k in range(1, 5):
        assert abs((sig[0] == sig[k]).mean() - similarity(w[0], w[k])) < 0.13


def test_weights_change_samples():
    """A sample follows the weight: the same shingles, other counts."""
    a, b = "p q r s t " * 1 + "u v w x y", "p q r s t " * 6 + "u v w x y"
    weights = N.Weights(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 2)
    (block,) = blocks(pa.array([a, b]))
    _, sig = N.samples(block, weights)
    assert (sig[0] != sig[1]).any()


def test_frequent_shingles_are_exact(spark):
    rng = random.Random(2)
    line = prose(rng, 12, 10**6)
    rows = [(i, (line + " " if i % 3 == 0 else "") + prose(rng, 30, 10**6), "en", "a", 1) for i in range(600)]
    weights = N.frequent_shingles(docs_frame(spark, rows).select("text").repartition(5))
    df = collections.Counter(s for r in rows for s in shingles(r[1]))
    assert len(weights.hashes) == sum(n * N.FLOOR > 600 for n in df.values())
    assert np.allclose(weights.idf[:8], 1 - math.log(1 / 3) / math.log(N.FLOOR))


def test_long_texts_make_few_frequent_slots(spark, monkeypatch):
    """Tasks with a few long texts each: chance makes no shingle frequent."""
    rng = random.Random(4)
    line = prose(rng, 12, 10**6)
    texts = [(line + " " if i % 2 else "") + prose(rng, 40_000, 10**8) for i in range(40)]
    docs = docs_frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)]).select("text").repartition(20)
    monkeypatch.setattr(N, "FLOOR", 4)
    assert 8 <= N._frequent_slots(docs, 40).count() < 100
    assert N._frequent_slots(docs, 10**9).count() > 10**5   # as it would be if each partition were judged alone
    assert len(N.frequent_shingles(docs).hashes) == 8


def every_weight(rows):
    """Shingle weights of every row by plain TF-IDF."""
    all_ = [shingles(r[1]) for r in rows]
    df = collections.Counter(s for c in all_ for s in c)
    return [{s: n * (1 + math.log(len(rows) / df[s]) / math.log(N.FLOOR)) for s, n in c.items()} for c in all_]


def brute_every(rows, monkeypatch):
    with monkeypatch.context() as m:
        m.setitem(globals(), "weighted", every_weight)
        return brute(rows)


def rare_and_frequent(seed):
    """Edited copies near the threshold: how much rarer own shingles are than
    those of a pair or of a group decides, below 1/FLOOR of the documents."""
    rng = random.Random(seed)
    rows = []
    for g in range(30):
        text = prose(rng, 150, 10**6)
        rows += [(1000 + 10 * g + k, edited(rng, text, rng.choice([0.004, 0.01, 0.015, 0.02])), "en", "a", 1) for k in range(rng.randrange(2, 8))]
    return rows + [(5000 + i, prose(rng, 8, 10**6), "en", "a", 1) for i in range(300)]


def test_queries_count_every_shingle(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from monthly_facts.llm import queries

    rows = awkward_rows(3) + rare_and_frequent(5) + repeated_lines(6, 3)
    want = brute_every(rows, monkeypatch)
    assert sum(a != b for a, b in zip(want, brute(rows))) > 5
    docs_frame(spark, rows, clash=True).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = collected(queries.op2_near_dedup(spark, str(tmp_path)))
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == want
    kept = collected(corpus_pipeline.near_dedup_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)))
    with monkeypatch.context() as m:
        m.setitem(globals(), "weighted", every_weight)
        assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(c) for c in classes_of(rows).values())


@pytest.mark.parametrize("part_bytes", [N.PART_BYTES, 16, 1])
def test_document_counts_of_every_shingle(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(N, "PART_BYTES", part_bytes)
    rows = awkward_rows(8) + families(9, 6)
    keyed = N._keyed(docs_frame(spark, rows).repartition(3))
    got = {r["node"]: np.frombuffer(r["docs"], dtype="<i8") for r in N._full_sketches(keyed, len(rows), sum(len(r[1] or "") for r in rows)).collect()}
    df = collections.Counter(s for r in rows for s in shingles(r[1]))
    nodes = {r["text"]: r["node"] for r in keyed.collect()}
    assert len(got) == len({t for t in nodes if words(t)})
    for text, node in nodes.items():
        if words(text):
            assert sorted(got[node].tolist()) == sorted(df[s] for s in shingles(text))


def test_copies_are_one_row_of_a_task(spark):
    rows = [(i, "one text that many have" if i % 2 else prose(random.Random(i), 9), "en", "a", 1) for i in range(400)]
    assert N._once_a_task(N._keyed(docs_frame(spark, rows).repartition(4))).count() == 200 + 4


def test_components(spark):
    rng = random.Random(6)
    links = [(i + 1, i) for i in range(200)] + [(rng.randrange(300, 600), rng.randrange(300, 600)) for _ in range(150)] + [(-5, -9)]
    got = {r["node"]: r["comp"] for r in N.components(spark.createDataFrame(links, "node bigint, hub bigint")).collect()}
    root = {x: x for l in links for x in l}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_empty(spark):
    docs = docs_frame(spark, [])
    assert N.near_duplicates(docs).collect() == [] and N.unique_documents(docs).collect() == []


def test_empty_with_every_shingle(spark):
    for rows in ([], [(1, None, None, None, None), (2, " ", "en", "a", 1)]):
        docs = docs_frame(spark, rows)
        assert sorted(r["doc_id"] for r in N.near_duplicates(docs, every_shingle=True).collect()) == [r[0] for r in rows]
        assert len(N.unique_documents(docs, every_shingle=True).collect()) == len(rows)

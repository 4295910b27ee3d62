import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from monthly_facts.llm import merkle, queries
from tests.llm.helpers import awkward_rows, collected, docs_frame


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, tamper=False):
    doc_id, text, lang, source, n_chars = row
    n_chars = n_chars + 1 if tamper and n_chars is not None else n_chars
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes, fanout):
    """Root and each node's path of (before, after)."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i in range(len(nodes)):
            first = at[i] // fanout * fanout
            paths[i].append(("".join(level[first:at[i]]), "".join(level[at[i] + 1:first + fanout])))
            at[i] //= fanout
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def brute(rows, fanout=2):
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]], fanout)
    root, above = tree([trees[g][0] for g in order], fanout)
    for g, up in zip(order, above):
        subroot, paths = trees[g]
        for i, (r, path) in enumerate(zip(groups[g], paths)):
            out.append((r[0], g, i, leaf(r), path + up, subroot, root, r))
    return out


def fold(node, path):
    for before, after in path:
        node = h(before, node, after)
    return node


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_paths_and_roots(spark, fanout):
    rows = awkward_rows()
    want = brute(rows, fanout)
    assert all(fold(w[3], w[4]) == w[6] for w in want)
    out = collected(merkle.proved(docs_frame(spark, rows, clash=True), fanout=fanout))
    key = lambda x: str((x[1], x[2]))
    got = [(r["doc_id"], r["lang"], r["position"], r["leaf"], [(s["before"], s["after"]) for s in r["path"]], r["subroot"], r["root"]) for r in out]
    assert sorted(got, key=key) == sorted([w[:7] for w in want], key=key)


def test_query(spark, workdir):
    rows = awkward_rows() + [(i, f"text {i}", "pt", "a", i) for i in range(1000, 1040)]
    docs_frame(spark, rows).write.parquet(workdir + "/documents.parquet")
    want = []
    for doc, _, _, leaf_, path, subroot, root, row in brute(rows):
        picked = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0
        folded = fold(leaf(row, picked), path)
        want.append((doc, leaf_, subroot, root, h(*[x for step in path for x in step]), folded, folded == root))
    got = [tuple(r) for r in queries.op12_merkle(spark, workdir).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {g[6] for g in got} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{workdir}/documents.parquet/*.parquet')")
    sql = con.execute(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({merkle.MANIFEST_SQL})").fetchall()
    assert sorted(map(str, sql)) == sorted(map(str, want))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300])
def test_sizes(spark, n):
    rows = [(i, "x", "en", "a", 1) for i in range(n)]
    out = collected(merkle.proved(docs_frame(spark, rows)))
    root, paths = tree([leaf(r) for r in rows], 2)
    assert {(r["position"], r["root"], len(r["path"])) for r in out} == {(i, root, len(p)) for i, p in enumerate(paths)}
    assert all(fold(r["leaf"], [(s["before"], s["after"]) for s in r["path"]]) == root for r in out)


def test_copies_of_one_row_do_not_gather(spark):
    """A third of all rows being one row, the sort still deals them out."""
    docs = docs_frame(spark, [(7, "same", "en", "a", 1)] * 2000 + [(i, f"t{i}", "en", "a", 1) for i in range(100, 300)])
    out = merkle.proved(docs)
    assert out.select("position").distinct().count() == 2200
    assert out.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_empty(spark):
    assert merkle.proved(docs_frame(spark, [])).collect() == []

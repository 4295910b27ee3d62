"""Merkle manifest of a dataset, with the proof of every row, by slot pivots.

A leaf is the hash of a row. The leaves of one group (say a language) in order
are hashed in runs of ``fanout`` until one node is left, the group's root; the
groups' roots in order of the group are hashed likewise to the dataset's root.
A run of fewer nodes, even of one, is hashed too; a lone leaf is its own root.

One aggregation spreads the children of a parent over columns: column i is
``max(node) when slot = i``. A pivot spans ``fanout ** LEVELS`` slots, so its
row holds a whole subtree: nodes of the next level are hashes of neighbouring
columns put together, and a column's siblings are the columns of its run
without its own. The trees grow by a factor of 16 a round, so the rounds are
few, and only the first one is over all rows. The way down joins each pivot
row, before its slots become rows again, with the path of its parent.

Leaves get their places by one range sort and the sizes of the sorted
partitions (which is all that the driver sees); equal rows are told apart by
where they are stored, so that neither a group nor a key nor copies of a row
gather in one task.

Hashes are lowercase hex SHA-256 of the inputs one after the other. A row's
input is every chosen column: ``-`` for null, else UTF-8 byte count, ``:``,
value.

Defined results: a null group is a group, first in order; null keys come last
in their group; rows of equal keys are ordered by their leaf, equal rows hold
neighbouring places and have proofs of their own; texts are hashed whole; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthly_facts.llm.tables import written

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT = 2
SLOTS = 16
# A step of a path: what stands before and after the own node in its run.
STEP = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Mapping[str, Column] | Sequence[str]) -> Column:
    values = columns.values() if isinstance(columns, Mapping) else map(F.col, columns)
    return digest(*[field(v) for v in values])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the steps of its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings of a path, bottom up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with its rows' places in the order, from 0, as ``rank``."""
    place = F.monotonically_increasing_id()
    table = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rank", place), name)
    task = F.shiftright("rank", 33)
    sizes = table.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, at = [], 0
    for r in sorted(sizes):
        starts.append((r["task"], at))
        at += r["n"]
    starts = df.sparkSession.createDataFrame(starts, "task bigint, start bigint")
    return table.join(starts, task == F.col("task")).withColumn(
        "rank", F.col("start") + F.col("rank").bitwiseAND(F.lit((1 << 33) - 1))).drop("task", "start")


def _pivot(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, list[str], list[str]]:
    """One row per parent of ``levels`` levels of (g, pos, n, node, carried):
    (g, pos, n, m: levels that this subtree has, s0, s1, ...), and as SQL the
    slots' paths inside the subtree and the nodes at its top by m."""
    slots = fanout ** levels
    held = ", ".join(c for c in nodes.columns if c not in ("g", "pos", "n"))
    spread = nodes.withColumn("slot", F.expr(f"pos % {slots}")).withColumn("pos", F.expr(f"pos div {slots}")).groupBy("g", "pos", "n").agg(
        *[F.expr(f"max(CASE WHEN slot = {i} THEN struct({held}) END) AS s{i}") for i in range(slots)])
    spread = spread.selectExpr("*", " + ".join(f"CAST(n > {fanout ** j} AS INT)" for j in range(levels)) + " AS m")
    names = [[f"s{i}.node" for i in range(slots)]]
    for level in range(1, levels + 1):
        below = names[-1]
        runs = [below[i:i + fanout] for i in range(0, len(below), fanout)]
        names.append([f"l{level}_{i}" for i in range(len(runs))])
        # A run's first node is there if any is.
        spread = spread.selectExpr("*", *[f"CASE WHEN {run[0]} IS NOT NULL THEN sha2({_together(run)}, 256) END AS {name}"
                                          for run, name in zip(runs, names[-1])])
    paths = []
    for i in range(slots):
        steps = []
        for level in range(1, levels + 1):
            own = i // fanout ** (level - 1)
            run = own // fanout * fanout
            before, after = names[level - 1][run:own], names[level - 1][own + 1:run + fanout]
            steps.append(f"CASE WHEN m >= {level} THEN named_struct('before', {_together(before)}, 'after', {_together(after)}) END")
        paths.append(f"array_compact(array({', '.join(steps)}))")
    return spread, paths, [names[level][0] for level in range(levels + 1)]


def _together(names: Sequence[str]) -> str:
    return f"concat({', '.join(f"coalesce({c}, '')" for c in names)})" if names else "''"


class _Trees:
    """The trees of (g, pos, n, node, carried) rows, n being the group's
    number of rows."""

    def __init__(self, nodes: DataFrame, fanout: int, name: str):
        self.fanout, self.name = fanout, name
        self.levels = max(1, int(math.log(SLOTS, fanout)))
        self.rounds = [nodes]
        most = nodes.agg(F.max("n")).first()[0] or 0
        while most > 1:
            spread, _, tops = _pivot(self.rounds[-1].select("g", "pos", "n", "node"), fanout, self.levels)
            slots = fanout ** self.levels
            up = spread.selectExpr("g", "pos", f"(n + {slots - 1}) div {slots} AS n", f"element_at(array({', '.join(tops)}), m + 1) AS node")
            self.rounds.append(written(up, f"{name}-{len(self.rounds)}"))
            most = -(-most // slots)

    def roots(self) -> DataFrame:
        """(g, node), a row per group."""
        return self.rounds[-1].select("g", "node")

    def paths(self, above: DataFrame) -> DataFrame:
        """The carried columns, node and path of each row and the other
        columns of ``above``, which has the roots' paths: (g, path, others)."""
        others = [c for c in above.columns if c not in ("g", "path")]
        paths = above.withColumn("pos", F.lit(0).cast("bigint"))
        for k in range(len(self.rounds) - 2, -1, -1):
            nodes = self.rounds[k]
            held = [c for c in nodes.columns if c not in ("g", "pos", "n")] if not k else []
            spread, inner, _ = _pivot(nodes if not k else nodes.select("g", "pos", "n", "node"), self.fanout, self.levels)
            rows = spread.join(paths, ["g", "pos"])
            each = ", ".join(f"named_struct('slot', {i}, 'held', s{i}, 'path', concat({p}, path))" for i, p in enumerate(inner))
            rows = rows.selectExpr("g", "pos", *others, f"inline(filter(array({each}), e -> e.held IS NOT NULL))")
            paths = rows.selectExpr("g", f"pos * {self.fanout ** self.levels} + slot AS pos", *others, "path", *[f"held.{c}" for c in held])
            if k:
                paths = written(paths, f"{self.name}-paths-{k}")
        if len(self.rounds) == 1:
            paths = self.rounds[0].join(paths, ["g", "pos"])
        return paths


def proved(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id",
           fanout: int = FANOUT, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``group``, ``key``, position (in its
    group), leaf, path (array of steps: before, after), subroot, root and the
    columns of ``carry``, which are worked out beside the leaf."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    carry = dict(carry or {})
    leaves = written(docs.select(F.col(group).alias("grp"), F.col(key).alias("k"), leaf_hash(columns).alias("leaf"),
                                 F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("carried")), "merkle-leaves")
    stored = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    rows = ranked(leaves.withColumn("stored", stored), [
        F.col("grp").asc_nulls_first(), F.col("k").asc_nulls_last(), F.col("leaf"), F.col("stored")], "merkle-sorted").drop("stored")
    groups = written(ranked(rows.groupBy("grp").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")),
                            [F.col("grp").asc_nulls_first()], "merkle-groups").withColumnRenamed("rank", "g"), "merkle-group-places")
    names = groups.select(F.col("grp").alias("grp_"), "g", "first", "n")
    nodes = rows.join(names, F.col("grp").eqNullSafe(F.col("grp_"))).select(
        "g", (F.col("rank") - F.col("first")).alias("pos"), "n", F.col("leaf").alias("node"), "k", "carried")
    trees = _Trees(written(nodes, "merkle-nodes"), fanout, "merkle")
    n_groups = groups.count()
    subroots = written(trees.roots().select(
        F.lit(0).cast("bigint").alias("g"), F.col("g").alias("pos"), F.lit(n_groups).cast("bigint").alias("n"), "node",
        F.col("g").alias("group_")), "merkle-subroots")
    top = _Trees(subroots, fanout, "merkle-top")
    root = top.roots().select("g", F.col("node").alias("root"), F.array().cast(STEP).alias("path"))
    above = written(top.paths(root).select(F.col("group_").alias("g"), "path", "root", F.col("node").alias("subroot")).join(
        groups.select("g", "grp"), "g"), "merkle-above")
    found = trees.paths(above)
    return found.select(F.col("grp").alias(group), F.col("k").alias(key), F.col("pos").alias("position"),
                        F.col("node").alias("leaf"), "path", "subroot", "root", *[F.col(f"carried.{n}").alias(n) for n in carry])


def _field_sql(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


# The query of the manifest in SQL, level by level: the whole trees, then each
# row's siblings in them. CRC-32 is worked out byte by byte.
MANIFEST_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
                              CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) t),
lf AS (SELECT doc_id, lang, sha256({" || ".join(map(_field_sql, COLUMNS))}) leaf,
              CASE WHEN xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                                        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 7 = 0
                   THEN sha256({" || ".join(_field_sql("(n_chars + 1)" if c == "n_chars" else c) for c in COLUMNS)}) END tampered
       FROM documents, crc),
d AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 pos, count(*) OVER (PARTITION BY lang) n,
             row_number() OVER () k FROM lf),
up AS (SELECT lang, 0 lvl, pos, n, leaf h FROM d UNION ALL
       SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
sub AS (SELECT lang, h subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 pos, count(*) OVER () n FROM up WHERE n = 1),
top AS (SELECT 0 lvl, pos, n, subroot h FROM sub UNION ALL
        SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n),
steps AS (SELECT k, 0 part, u.lvl, (d.pos >> u.lvl) & 1 own, s.h FROM d
          JOIN up u ON u.lang IS NOT DISTINCT FROM d.lang AND u.pos = d.pos >> u.lvl AND u.n > 1
          LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM d.lang AND s.lvl = u.lvl AND s.pos = xor(u.pos, 1)
          UNION ALL
          SELECT k, 1, u.lvl, (sub.pos >> u.lvl) & 1, s.h FROM d JOIN sub ON sub.lang IS NOT DISTINCT FROM d.lang
          JOIN top u ON u.pos = sub.pos >> u.lvl AND u.n > 1 LEFT JOIN top s ON s.lvl = u.lvl AND s.pos = xor(u.pos, 1)),
proof AS (SELECT k, string_agg(coalesce(h, ''), '' ORDER BY part, lvl) proof, list(own || coalesce(h, '') ORDER BY part, lvl) steps FROM steps GROUP BY k),
f AS (SELECT d.doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) root, sha256(coalesce(proof, '')) proof_sha256,
             list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])), lambda a, s:
                         sha256(CASE WHEN s[1] = '1' THEN s[2:] || a ELSE a || s[2:] END)) folded_root
      FROM d JOIN sub ON sub.lang IS NOT DISTINCT FROM d.lang LEFT JOIN proof USING (k))
SELECT *, folded_root = root verified FROM f"""

"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation
maximisation over the counts of vote patterns (all documents; at most 3^m
patterns for m labellers) estimates how each labeller votes on good and on bad
documents, and gives each pattern the posterior that its documents are good.
The posteriors of a bounded sample, the ``TRAIN_DOCS`` or so different
documents with the lowest hash, are the soft targets of a logistic model over ``DIMS`` hashed
features (of each word: itself, the shapes of its head and tail, whether it
repeats the word before). The sample is chosen by hashes alone; its texts are
turned into features in many tasks, a block at a time, and at most
2 * TRAIN_DOCS * DIMS numbers come to the driver. The model then scores every
whole document.

Gold labels are not used; tests hold the scores against them.

Defined results: null or empty text has no features, its score is that of the
model's constant, and it is not kept; equal texts have equal scores; an empty
table gives an empty result. Which class is "good" is fixed by the start of
the estimation: good documents rarely get bad votes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthly_facts.llm.fertility import SYMBOLS
from monthly_facts.llm.tables import HASH_BITS, written
from monthly_facts.llm.words import Block, blocks, duplicate_lines, hash_spans, mix64, per_doc, repeat_words

TRAIN_DOCS = 4096
DIMS = 4096
FEATURES = 4
ROUNDS = 100
STEPS = 300
L2 = 1e-4

ABSTAIN, GOOD, BAD = 0, 1, 2
# The measure a labeller looks at (a share of the document's
# words), up to which value it votes good (-1: never) and from which bad.
LABELLERS = (
    ("not_plain", 0.1, 0.3),
    ("echo", 0.02, 0.2),
    ("repeats", 0.2, 0.5),
    ("symbols", -1, 0.3),
    ("bars", -1, 0.1),
    ("shouting", -1, 0.3),
    ("marks", -1, 0.3),
    ("dup_lines", -1, 0.05),
)
# A document with fewer words says too little for any vote.
MIN_VOTE_WORDS = 5


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL, _BAR, _MARK = _flags(SYMBOLS), _flags(b"|"), _flags(b"!?")
_STOP, _LETTER = _flags(b".,"), _flags(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0x80, 0x100)))
_UPPER, _LOWER = _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags(b"abcdefghijklmnopqrstuvwxyz")
# A byte's class in word shapes: letters, digits and the lead and following
# bytes of other characters are classes, all else stands for itself.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[_UPPER], _CLASS[_LOWER] = ord("A"), ord("a")
_CLASS[ord("0"):ord("9") + 1] = ord("0")
_CLASS[0x80:0xC0], _CLASS[0xC0:] = 0x80, 0xC0


def _echo(block: Block, hashes: np.ndarray) -> np.ndarray:
    """Words equal to the word before them."""
    out = np.zeros(len(hashes), dtype=bool)
    out[1:] = hashes[1:] == hashes[:-1]
    first = block.word_offsets[:-1]
    out[first[first < len(out)]] = False
    return out


def votes(block: Block) -> np.ndarray:
    """One number per document: the votes as digits of base 3."""
    hashes, body = block.hashes(), block.data[:block.offsets[-1]]
    n = np.maximum(block.n_words, 1)

    def share(flags):
        return per_doc(flags[body], block.offsets) / n

    def inside(flags, ends):
        total = np.concatenate([[0], np.cumsum(flags[body], dtype=np.int64)])
        return total[ends] - total[block.starts]
    # A plain word is letters, perhaps with a comma or full stop behind; a
    # word shouts if it has capitals and no small letters.
    last = np.where(_STOP[body[block.ends - 1]], block.ends - 1, block.ends)
    plain = (inside(_LETTER, last) == last - block.starts) & (last > block.starts)
    loud = (inside(_UPPER, block.ends) > 1) & (inside(_LOWER, block.ends) == 0)
    seen = {
        "not_plain": per_doc(~plain, block.word_offsets) / n,
        "echo": per_doc(_echo(block, hashes), block.word_offsets) / n,
        "repeats": repeat_words(block, hashes, 3) / n,
        "symbols": share(_SYMBOL), "bars": share(_BAR), "marks": share(_MARK),
        "shouting": per_doc(loud, block.word_offsets) / n,
        "dup_lines": duplicate_lines(block) / n,
    }
    out = np.zeros(len(block), dtype=np.int64)
    for name, low, high in LABELLERS:
        vote = np.where(seen[name] <= low, GOOD, np.where(seen[name] >= high, BAD, ABSTAIN))
        out = out * 3 + np.where(block.n_words >= MIN_VOTE_WORDS, vote, ABSTAIN)
    return out


def features(block: Block) -> np.ndarray:
    """Hashed features of each word, in rows."""
    n, hashes = np.uint64(DIMS), block.hashes()
    shapes = _CLASS[block.data]
    head = hash_spans(shapes, block.starts, np.minimum(block.ends, block.starts + 2))
    tail = hash_spans(shapes, np.maximum(block.starts, block.ends - 4), block.ends)
    echo = _echo(block, hashes).astype(np.uint64)
    return np.stack([hashes % n] + [mix64(x + np.uint64(k)) % n for k, x in enumerate((head, tail, echo), start=1)]).astype(np.int64)


def estimate(patterns: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS),
             rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation. Returns the posterior of good per pattern,
    P(vote | class) as [labeller, class (bad, good), vote], and the share of
    good documents."""
    vote = np.stack([patterns // 3 ** (labellers - 1 - k) % 3 for k in range(labellers)])
    one_hot = np.stack([vote == v for v in range(3)], axis=2).astype(float)  # labeller, pattern, vote
    table = np.tile(np.array([[0.4, 0.35, 0.25], [0.4, 0.58, 0.02]]), (labellers, 1, 1))
    prior = 0.8
    posterior = np.full(len(patterns), prior)
    for _ in range(rounds):
        log = np.einsum("lpv,lcv->cp", one_hot, np.log(table))
        log += np.log([[1 - prior], [prior]])
        log -= log.max(axis=0)
        both = np.exp(log)
        posterior = both[1] / both.sum(axis=0)
        weight = np.stack([1 - posterior, posterior]) * counts
        table = np.einsum("lpv,cp->lcv", one_hot, weight) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = float(np.clip((weight[1].sum() + 1) / (counts.sum() + 2), 1e-6, 1 - 1e-6))
    return posterior, table, prior


def train(rows: list[np.ndarray], values: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Weights (the last is the constant) of a logistic model for soft
    targets, by full gradient steps with momentum. Classes weigh the same."""
    if not rows:
        return np.zeros(DIMS + 1)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col, val = np.concatenate(rows), np.concatenate(values)
    good = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    weight = target / good / 2 + (1 - target) / (1 - good) / 2
    w, m, v = np.zeros(DIMS + 1), np.zeros(DIMS + 1), np.zeros(DIMS + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(doc, weights=w[col] * val, minlength=len(rows)) + w[-1]
        off = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(rows)
        g = np.append(np.bincount(col, weights=off[doc] * val, minlength=DIMS), off.sum()) + L2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def _patterns(docs: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                found = pa.array(votes(block)).dictionary_encode()
                sums = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
                yield pa.RecordBatch.from_arrays([found.dictionary, pa.array(sums)], names=["pattern", "n"])
    return docs.select("text").mapInArrow(read, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


def _training_rows(sample: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                pattern, doc = votes(block), np.tile(block.doc_of_word(), FEATURES)
                keys, counts = np.unique(doc * DIMS + features(block).ravel(), return_counts=True)
                edges = np.searchsorted(keys, np.arange(len(block) + 1) * DIMS)
                col, val = keys % DIMS, counts / np.maximum(block.n_words, 1)[keys // DIMS]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(block)), pa.array(pattern),
                     pa.LargeListArray.from_arrays(edges, pa.array(col.astype(np.int32))).cast(pa.list_(pa.int32())),
                     pa.LargeListArray.from_arrays(edges, pa.array(val.astype(np.float32))).cast(pa.list_(pa.float32()))],
                    names=["h", "pattern", "col", "val"])
    return sample.select("h", "text").mapInArrow(read, "h bigint, pattern bigint, col array<int>, val array<float>")


def _scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("pattern", T.LongType()), T.StructField("score", T.DoubleType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                sums = np.bincount(block.doc_of_word(), weights=weights[features(block)].sum(axis=0), minlength=len(block))
                z = sums / np.maximum(block.n_words, 1) + weights[-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(block)), pa.array(block.n_words), pa.array(votes(block)),
                     pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=schema.names)
    return docs.select("doc_id", "text").mapInArrow(read, schema)


def training_sample(docs: DataFrame, total: int, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(h, doc_id, text) of the different (doc_id, text) of ``docs`` (``total``
    rows) with the lowest hashes: about ``train_docs``, at most twice that."""
    # Hashed with the text, as many rows may have one id.
    key = F.concat_ws(" ", F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    hashed = docs.select("doc_id", "text", F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint").alias("h"))
    if total > train_docs:
        hashed = hashed.where(F.col("h") < int(train_docs / total * (1 << HASH_BITS)))
    # One task sees hashes only, no texts.
    chosen = written(hashed.select("h").distinct().orderBy("h").limit(2 * train_docs), "label-sample")
    return hashed.join(chosen, "h", "left_semi").dropDuplicates(["h"]).select("h", "doc_id", "text")


def scored(docs: DataFrame, train_docs: int = TRAIN_DOCS, threshold: float = 0.5) -> DataFrame:
    """doc_id, votes (base 3 digits), posterior (of the vote pattern), score,
    kept."""
    spark = docs.sparkSession
    counts = _patterns(docs).toPandas()  # at most 3^8 rows
    total = int(counts["n"].sum())
    pattern = counts["pattern"].to_numpy(dtype=np.int64)
    posterior, _, _ = estimate(pattern, counts["n"].to_numpy(dtype=float)) if total else (np.zeros(0), None, 0)
    sample = _training_rows(training_sample(docs, total, train_docs)).toPandas().sort_values("h")
    known = dict(zip(pattern.tolist(), posterior.tolist()))
    soft = np.array([known.get(p, 0.5) for p in sample["pattern"].tolist()])
    weights = train([np.asarray(x) for x in sample["col"]], [np.asarray(x) for x in sample["val"]], soft)
    table = written(spark.createDataFrame(
        [(int(p), float(q)) for p, q in known.items()], "pattern bigint, posterior double").coalesce(1), "label-patterns")
    kept = (F.col("score") >= threshold) & (F.col("n_words") > 0)
    return _scores(docs, weights).join(table, "pattern", "left").select(
        "doc_id", F.lpad(F.conv(F.col("pattern").cast("string"), 10, 3), len(LABELLERS), "0").alias("votes"),
        "posterior", "score", kept.alias("kept"))

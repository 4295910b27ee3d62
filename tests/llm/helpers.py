"""Small documents with every awkward case, and words as the contracts have them."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that clash with names the operators use themselves.
CLASH = ", size bigint, hash bigint, shard_key string, words string, node bigint, taken bigint, n_words string, entry string"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward_rows(seed=1, n=60):
    """(doc_id, text, lang, source, n_chars): copies, near copies, nulls,
    empty, blank and long texts, repeated rows, shared passages."""
    rng = random.Random(seed)
    shared = prose(rng, 55, 5000)
    rows = []
    for i in range(n):
        text = prose(rng, rng.choice([3, 30, 60, 120, 300]), 3000)
        if i % 4 == 0:
            text = text[:len(text) // 2] + "\n" + shared + " " + text[len(text) // 2:]
        rows.append((i, text, rng.choice(["en", "fr", "de", None, "xx"]), rng.choice(["a", "b", "c", None, "a", "a"]), len(text)))
    rows.append((n, rows[3][1], "en", "a", None))          # exact copies
    rows.append((n + 1, rows[3][1], "en", "b", 3))
    long = prose(rng, 3000, 2000)
    rows.append((n + 2, long, "en", "a", 0))
    near = long.split(" ")
    for k in range(0, 3000, 300):
        near[k] = "changed"
    rows.append((n + 3, "  ".join(near), "en", "c", 0))    # a near copy, other spaces
    rows.append((n + 4, None, None, None, None))
    rows.append((n + 5, "", "en", "a", 0))
    rows.append((n + 6, " \n\t ", "en", "a", 4))
    rows.append((None, prose(rng, 80), "en", "b", 1))      # no id
    rows.append((None, None, None, None, None))
    rows.append(rows[5])                                   # repeated rows
    rows.append(rows[5])
    rows.append((n + 7, "a b a b a b " * 30, "en", "d", 1))  # a period
    rows.append((n + 8, "日本語 текст ümlaut 👩‍👩‍👧 " * 20, "ja", "d", 1))
    rows.append((7, "another text under an id that is taken " * 8, "en", "a", 1))
    return rows


def docs_frame(spark, rows, clash=False):
    if not clash:
        return spark.createDataFrame(rows, DOCS)
    return spark.createDataFrame([(*r, 1, 2, "k", "w", 3, 4, "n", "e") for r in rows], DOCS + CLASH)


def collected(df):
    return [r.asDict() for r in df.collect()]

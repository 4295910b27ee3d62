"""Benchmark decontamination: short test items inside long documents.

Text is compared as words (runs of letters and digits, in lower case) in
shingles of five; a text of one to four words is one shingle by itself, so an
item that short is found only in a text of the same words. An item is found in a document if at least ``THRESHOLD`` of its shingles are.

Search is by MinHash sketches whose size follows the item's size. A document
that holds ceil(0.8 q) of an item's q shingles holds at least one of any
q - ceil(0.8 q) + 1 of them, so the item is entered under that many, the lowest
in an order by corpus frequency (in powers of two) and then by hash: no item is
missed, and passages that many documents share name no candidates unless an
item is made of them. Items are partitioned by size (powers of two), and a
document is probed only for the partitions whose smallest item it is long
enough to hold. For a candidate pair the shared shingle hashes are counted, and
only pairs with ceil(0.8 q) of them are verified on the shingles themselves, as
text.

Only DataFrame functions are used. The corpus is read once for its shingles: a
bit table of the items' shingles, of at most 2^``BIT_WORDS`` rows and therefore
broadcast, drops almost all others where they are made; what is left meets the
items' shingles by equality (broadcast only if the planner finds their files
small) and is written, with frequencies, candidates and counts worked out from
that.

Defined results: null or wordless texts and items match nothing; items with
the same text are all reported; documents with equal texts are all reported;
an empty table on either side gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthly_facts.llm.tables import OWN, written

SHINGLE = 5
THRESHOLD = 0.8
BIT_WORDS = 18


def with_words(df: DataFrame, text: str = "text", name: str = "words") -> DataFrame:
    """Adds the compared words of ``text`` as an array."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return df.withColumn(name, F.array_remove(found, ""))


def shingle_hashes(words: str = "words") -> Column:
    n = F.size(words)
    full = F.transform(F.sequence(F.lit(0), n - SHINGLE),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    return F.when(n >= SHINGLE, full).when(n > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(
        F.array().cast("array<bigint>"))


def shingles(words: str = "words") -> Column:
    n = F.size(words)
    full = F.transform(F.sequence(F.lit(1), n - SHINGLE + 1), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    return F.when(n >= SHINGLE, full).when(n > 0, F.array(F.array_join(words, " "))).otherwise(
        F.array().cast("array<string>"))


def _held(items: DataFrame, threshold: float) -> DataFrame:
    """(item, n, needed, part, h): every different shingle of each item."""
    hashed = items.withColumn("hs", F.array_distinct(shingle_hashes())).withColumn("n", F.size("hs"))
    needed = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return hashed.where("n > 0").select(
        "item", "n", needed.alias("needed"), F.floor(F.log2("n")).cast("int").alias("part"), F.explode("hs").alias("h"))


def _word(h: str) -> Column:
    return F.shiftright(h, 6).bitwiseAND(F.lit((1 << BIT_WORDS) - 1))


def _met(docs: DataFrame, held: DataFrame) -> DataFrame:
    """(text_key, n_held, h): shingles of items in each different text, which
    has ``n_held`` shingles."""
    words = held.select(_word("h").alias("word"), F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit")).groupBy("word").agg(
        F.bit_or("bit").alias("bits"))
    words = written(words, "decontam-bits")   # at most 2^BIT_WORDS rows
    probes = with_words(docs.select("text", F.xxhash64("text").alias("text_key"))).select("text_key", shingle_hashes().alias("hs"))
    # The size is worked out first, as an exploded row shall not carry the
    # array; the outer form keeps the planner from testing the array's size by
    # working out its words again for each of its elements. A null meets nothing.
    probes = probes.select("text_key", "hs", F.size("hs").alias("n_held")).select("text_key", "n_held", F.explode_outer("hs").alias("h"))
    likely = probes.join(F.broadcast(words), _word("h") == F.col("word")).where("getbit(bits, CAST(h & 63 AS INT)) = 1")
    return likely.select("text_key", "n_held", "h").join(held.select("h").distinct(), "h", "left_semi").distinct()


def _candidates(met: DataFrame, held: DataFrame) -> DataFrame:
    """(text_key, item): pairs that share as many shingle hashes as needed."""
    found = met.groupBy("h").agg(F.count(F.lit(1)).alias("n_texts"))
    # An item's own shingles: as many rows as a short text has words.
    order = Window.partitionBy("item").orderBy(F.floor(F.log2(F.coalesce("n_texts", F.lit(0)) + 1)), "h")
    entries = held.join(found, "h", "left").withColumn("place", F.row_number().over(order)).where("place <= n - needed + 1")
    # At most 32 partitions: what their smallest items need.
    least = held.groupBy("part").agg(F.min("needed").alias("least"))
    entries = entries.join(least, "part").select("h", "item", "least")
    pairs = met.join(entries, "h").where("n_held >= least").select("text_key", "item").distinct()
    shared = written(pairs, "decontam-pairs").join(held, "item").join(met.select("text_key", "h"), ["text_key", "h"])
    return shared.groupBy("text_key", "item", "needed").agg(F.count(F.lit(1)).alias("n")).where("n >= needed").select("text_key", "item")


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(text_key, item_id, n_shared, n_item, containment) for each different
    text of ``docs`` and each item found in it. ``text_key`` is
    ``xxhash64(text)``."""
    tests = with_words(items.select(F.col("item_id").alias("item_id"), "text")).select(
        "item_id", "words", F.xxhash64("words").alias("item"))
    tests = written(tests, "decontam-items")
    held = written(_held(tests.dropDuplicates(["item"]), threshold), "decontam-shingles")
    met = written(_met(docs, held), "decontam-met")
    pairs = written(_candidates(met, held), "decontam-candidates")
    # The candidates' texts; equal texts meet once per task before the shuffle.
    wanted = pairs.select("text_key").distinct()
    texts = docs.select("text", F.xxhash64("text").alias("text_key")).join(wanted, "text_key", "left_semi").dropDuplicates(["text_key"])
    tried = (
        with_words(texts).select("text_key", F.array_distinct(shingles()).alias("held")).join(pairs, "text_key")
        .join(tests.dropDuplicates(["item"]).select("item", F.array_distinct(shingles()).alias("asked")), "item")
        .select("text_key", "item", F.size(F.array_intersect("asked", "held")).cast("bigint").alias("n_shared"),
                F.size("asked").cast("bigint").alias("n_item"))
        .where(F.col("n_shared") >= F.col("n_item") * threshold - 1e-9)
    )
    return tried.join(tests.select("item", "item_id"), "item").select(
        "text_key", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment."""
    found = written(contained(docs, items, threshold), "decontam-found")
    return docs.select("doc_id", F.xxhash64("text").alias("text_key")).join(found, "text_key").drop("text_key")


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    found = written(contained(docs, items, threshold).select(F.col("text_key").alias(OWN + "key")).distinct(), "decontam-found")
    return docs.join(found, F.xxhash64("text") == F.col(OWN + "key"), "left_anti")


def contaminated_sql(threshold: float = THRESHOLD) -> str:
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    grams = """CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"""
    return f"""
WITH i AS (SELECT item_id, unnest(list_distinct({grams})) s, len(list_distinct({grams})) n FROM (SELECT item_id, {words} w FROM benchmark)),
d AS (SELECT doc_id, n_row, unnest(list_distinct({grams})) s FROM (SELECT doc_id, row_number() OVER () n_row, {words} w FROM documents)),
m AS (SELECT doc_id, n_row, item_id, count(*) n_shared, any_value(n) n_item FROM d JOIN i USING (s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_shared AS BIGINT) n_shared, CAST(n_item AS BIGINT) n_item, n_shared / n_item containment
FROM m WHERE n_shared >= n_item * {threshold} - 1e-9"""

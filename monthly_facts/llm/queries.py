"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts.llm import (
    decontam,
    fertility,
    hard_negatives,
    merkle,
    mixing,
    near_dedup,
    packing,
    preference,
    sharding,
    substring_dedup,
    unigram_count,
    url_vocab,
    weak_label,
)
from monthly_facts.llm.tables import OWN, ROW_HASH_SQL, content_hash_sql, table

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), every_shingle=True)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = fertility.judged(docs, keep_text=False)
    names = [*fertility.COUNTS, "base_failed", "kept", *fertility.MEASURES]
    return found.select("doc_id", *[F.col(OWN + c).alias(c) for c in names])


def op5_weak_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_label.scored(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.sharded(docs).drop("text")


def op7_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = preference.conversations(table(spark, sf_dir, "conversations"))
    return preference.formatted(preference.with_other_reply(convs))


def op8_unigram_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_count.counted(table(spark, sf_dir, "documents"))


def op9_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_vocab.judged(table(spark, sf_dir, "pages"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digested(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = {c: F.col(c) for c in merkle.COLUMNS}
    tampered = merkle.leaf_hash(columns | {"n_chars": F.col("n_chars") + 1})
    picked = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    rows = merkle.proved(docs, carry={"tampered": F.when(picked, tampered)})
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
                       root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


# The targets in closed form: sources by words for a weight of one, capped
# ones first; the share is the first at which the rest stays under its cap.
OP1_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) size, {ROW_HASH_SQL} h,
                  {content_hash_sql(DOCUMENTS)} h2 FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 w FROM d GROUP BY source),
o AS (SELECT *, CAST(coalesce(sum(3 * source_size) OVER before, 0) AS BIGINT) capped,
             CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS BIGINT) open_w, CAST(sum(source_size) OVER () AS BIGINT) total
      FROM s WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (SELECT arg_min((total - capped) / open_w, k) l FROM (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) k FROM o)
          WHERE w * ((total - capped) / open_w) <= 3 * source_size),
t AS (SELECT source, source_size, least(w * coalesce(l, 1e300), 3 * source_size)::DOUBLE target FROM s, share),
c AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END copies FROM t),
g AS (SELECT source, h, h2, sum(size) words, count(*) n FROM d GROUP BY ALL),
r AS (SELECT g.source, h, h2, words, n, target - copies * source_size rest,
             sum(words) OVER (PARTITION BY g.source ORDER BY h, h2) upto FROM g JOIN c ON g.source IS NOT DISTINCT FROM c.source),
top AS (SELECT source, h top, h2 top2, least(n, floor((rest - (upto - words)) / (words / n) + 0.5)) more FROM r
        WHERE rest > 0 AND upto - words < rest AND rest <= upto),
i AS (SELECT *, row_number() OVER (PARTITION BY source, h, h2) i FROM d)
SELECT doc_id, size, source_size, target,
       CAST(size * (copies + CASE WHEN h < top OR h = top AND (h2 < top2 OR h2 = top2 AND i <= more) THEN 1 ELSE 0 END) AS BIGINT) taken
FROM i JOIN c ON i.source IS NOT DISTINCT FROM c.source LEFT JOIN top ON i.source IS NOT DISTINCT FROM top.source"""

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_near_dedup": op2_near_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_fertility": op4_fertility,
    "op5_weak_label": op5_weak_label,
    "op6_sharding": op6_sharding,
    "op7_preference": op7_preference,
    "op8_unigram_count": op8_unigram_count,
    "op9_url_vocabulary": op9_url_vocabulary,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_packing": op11_packing,
    "op12_merkle": op12_merkle,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_mixing": OP1_SQL,
    "op3_decontamination": decontam.contaminated_sql(),
    "op6_sharding": sharding.sharding_sql(),
    "op7_preference": preference.PREFERENCE_SQL,
    "op9_url_vocabulary": url_vocab.judged_sql(),
    "op12_merkle": merkle.MANIFEST_SQL,
    "op13_hard_negatives": hard_negatives.MINED_SQL,
}

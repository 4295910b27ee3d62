"""Preference formatting: a chosen and a rejected conversation become one
prompt (their longest common prefix of turns, rendered once) and two
completions with loss masks.

A turn is rendered as ``<|role|>\\n`` + text + ``\\n``. A mask is a list of
runs over the characters of a completion: ``m12 l340`` means 12 masked
characters, then 340 that are learned. Learned are the text and line end of
assistant turns; headers and all other turns are masked, and so is the whole
prompt.

Defined results: turns are ordered by turn (null last), role, text (null
first); rows without a conversation id belong to no conversation and are left
out; a null role or text renders as empty and equals only null; a missing
side counts as a conversation of no turns; equal conversations give two empty
completions; an empty table gives an empty result. Repeated rows are repeated
turns. A conversation is one example, so its turns are gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"


def conversations(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, turns): the ordered turns as an array of (role, text)."""
    entry = F.struct(F.col("turn").isNull().alias("last"), F.col("turn").alias("turn"),
                     F.col("role").alias("role"), F.col("text").alias("text"))
    return (
        turns.where(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id"))
        .agg(F.sort_array(F.collect_list(entry)).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def with_other_reply(convs: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): the rejected side is the conversation with
    its last assistant reply exchanged for that of its neighbour (conv_id with
    the lowest bit flipped; an empty reply where there is none)."""
    is_reply = F.transform("turns", lambda t: t["role"].eqNullSafe(F.lit(LEARNED_ROLE)))
    back = F.array_position(F.reverse(is_reply), True)
    at = F.when(back > 0, F.size("turns") - back).cast("int")  # 0-based; null: no reply
    sided = convs.withColumn("at", at)
    other = sided.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
                         F.when(F.col("at").isNotNull(), F.col("turns")[F.col("at")]["text"]).alias("other"))
    swapped = F.transform("turns", lambda t, i: F.when(
        i == F.col("at"), F.struct(t["role"].alias("role"), F.coalesce("other", F.lit("")).alias("text"))).otherwise(t))
    return sided.join(other, "conv_id", "left").select("conv_id", F.col("turns").alias("chosen"), swapped.alias("rejected"))


def _header(t: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("")), F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), F.coalesce(t["text"], F.lit("")), F.lit("\n"))), "")


def _mask(turns: Column) -> Column:
    def runs(t):
        head = F.length(_header(t))
        body = F.length(F.coalesce(t["text"], F.lit(""))) + 1
        return F.when(t["role"].eqNullSafe(F.lit(LEARNED_ROLE)), F.concat(F.lit("m"), head, F.lit(" l"), body)).otherwise(
            F.concat(F.lit("m"), head + body))
    return F.array_join(F.transform(turns, runs), " ")


def formatted(pairs: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected) arrays of (role, text) -> conv_id,
    prefix_turns, prompt, chosen, chosen_mask, rejected, rejected_mask."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select("conv_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    first = F.array_position(same, False)
    cut = sides.withColumn("n", F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int"))
    rest = lambda side: F.slice(F.col(side), F.col("n") + 1, F.size(side) + 1)
    return cut.select(
        "conv_id", F.col("n").cast("bigint").alias("prefix_turns"),
        _rendered(F.slice(F.col("c"), F.lit(1), F.col("n"))).alias("prompt"),
        _rendered(rest("c")).alias("chosen"), _mask(rest("c")).alias("chosen_mask"),
        _rendered(rest("r")).alias("rejected"), _mask(rest("r")).alias("rejected_mask"),
    )


PREFERENCE_SQL = """
WITH conv AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) t
              FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
pos AS (SELECT conv_id, t, list_max(list_filter(list_transform(range(1, len(t) + 1), lambda i: CASE WHEN t[i].role = 'assistant' THEN i END),
        lambda i: i IS NOT NULL)) k FROM conv),
pair AS (SELECT a.conv_id, a.t c, list_transform(a.t, lambda x, i: CASE WHEN i = a.k THEN
        struct_pack(role := x.role, text := coalesce(b.t[b.k].text, '')) ELSE x END) r
        FROM pos a LEFT JOIN pos b ON b.conv_id = xor(a.conv_id, 1)),
cut AS (SELECT *, len(list_filter(range(1, len(c) + 1), lambda i: c[1:i] IS NOT DISTINCT FROM r[1:i])) n FROM pair),
turns AS (SELECT conv_id, n, list_transform(c, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || chr(10)) ct,
        list_transform(r, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || chr(10)) rt,
        list_transform(c, lambda x: CASE WHEN x.role = 'assistant' THEN 'm14 l' || (length(coalesce(x.text, '')) + 1)
          ELSE 'm' || (length(coalesce(x.role, '')) + 5 + length(coalesce(x.text, '')) + 1) END) cm,
        list_transform(r, lambda x: CASE WHEN x.role = 'assistant' THEN 'm14 l' || (length(coalesce(x.text, '')) + 1)
          ELSE 'm' || (length(coalesce(x.role, '')) + 5 + length(coalesce(x.text, '')) + 1) END) rm FROM cut)
SELECT conv_id, CAST(n AS BIGINT) prefix_turns, coalesce(array_to_string(ct[1:n], ''), '') prompt,
       coalesce(array_to_string(ct[n+1:], ''), '') chosen, coalesce(array_to_string(cm[n+1:], ' '), '') chosen_mask,
       coalesce(array_to_string(rt[n+1:], ''), '') rejected, coalesce(array_to_string(rm[n+1:], ' '), '') rejected_mask
FROM turns"""

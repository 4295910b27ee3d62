"""URL filter: allow and block rules by host and path, and a weighted
vocabulary found by one Aho-Corasick automaton.

A URL is blocked by the vocabulary if it has one strict term or at least
``MIN_SOFT`` different soft terms. A term counts only between boundaries: the
character before and the one after must not be an ASCII letter or digit. The
URL is searched whole, A-Z in lower case.

Defined results: null or a URL without ``://`` has empty host and path; no
rule fits an empty host; the vocabulary is searched in it all the same (null:
nothing found, allow). Repeated rows give repeated results; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_CHARS = frozenset(LOWER + "0123456789")

# Fixed values: (verdict, host, path). The longest rule that fits wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# One of these is enough.
STRICT = ("adult", "casino", "escort", "hentai", "porn", "porno", "sex", "viagra", "xxx")
# Harmless alone.
SOFT = ("ads", "bet", "bets", "bonus", "buy", "cheap", "click", "coupon", "dating", "farm", "free", "jackpot",
        "loan", "loans", "lottery", "pills", "poker", "replica", "slots", "spam", "track", "win")
MIN_SOFT = 2


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(after, r"^[^?#]*", 0)


def fitting_rule(host: Column, path: Column, rules: Sequence = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


@functools.lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    a = ahocorasick.Automaton()
    for kind, terms in ((0, soft), (1, strict)):
        for t in terms:
            a.add_word(t, (kind, t))
    a.make_automaton()
    return a


def _hits(url: str | None, automaton) -> tuple[int, int]:
    """Different strict and soft terms of one URL."""
    found: tuple[set, set] = (set(), set())
    for end, (kind, term) in automaton.iter(url or ""):
        start = end - len(term) + 1
        if (not start or url[start - 1] not in WORD_CHARS) and (end + 1 == len(url) or url[end + 1] not in WORD_CHARS):
            found[kind].add(term)
    return len(found[1]), len(found[0])


def term_hits(strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT):
    """Pandas UDF: lower-cased URL -> struct(strict, soft)."""
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("strict bigint, soft bigint")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(strict, soft)
        for urls in parts:
            yield pd.DataFrame([_hits(u, automaton) for u in urls], columns=["strict", "soft"], dtype="int64")
    return count


def judged(pages: DataFrame, rules: Sequence = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT,
           min_soft: int = MIN_SOFT) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits."""
    host, path = host_and_path("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"),
                         term_hits(strict, soft)(F.translate("url", UPPER, LOWER)).alias("hits"))
    rule, by_rule = fitting_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("hits.strict") > 0) | (F.col("hits.soft") >= min_soft), "block").otherwise("allow")
    return split.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, by_terms).alias("verdict"),
                        F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"))


def judged_sql() -> str:
    def count(terms):
        return "CAST(" + " + ".join(
            f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INTEGER)" for t in terms) + " AS BIGINT)"
    cases = [(k, h, p) for k, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    when = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {when(h, p)} THEN '{h}{p}'" for _, h, p in cases) + " END"
    verdict = "CASE " + " ".join(f"WHEN {when(h, p)} THEN '{k}'" for k, h, p in cases) + \
        f" WHEN strict_hits > 0 OR soft_hits >= {MIN_SOFT} THEN 'block' ELSE 'allow' END"
    return f"""
WITH a AS (SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') u,
                  CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END rest FROM pages),
b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') raw FROM a),
c AS (SELECT page_id, u, translate(raw, '{UPPER}', '{LOWER}') host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') path FROM b),
d AS (SELECT page_id, host, path, {count(STRICT)} strict_hits, {count(SOFT)} soft_hits FROM c)
SELECT page_id, host, path, {rule} "rule", {verdict} verdict, strict_hits, soft_hits FROM d"""

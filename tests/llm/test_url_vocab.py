import re
import string

import duckdb
import pytest

from monthly_facts.llm import url_vocab as U
from tests.llm.helpers import collected

URLS = [
    None, "", "no-scheme.example.org/es/", "http://", "https://Example.ORG/es/x", "https://a.example.org/es/x", "https://badexample.org/es/x",
    "http://example.org/en/12", "http://example.org/en/2", "http://x.com/fr/casino", "http://x.com/de/fine", "http://x.com/de", "http://org", "http://org/",
    "http://x.net/casino", "http://x.net/casinos", "http://x.net/my-CASINO?q", "http://x.net/xcasino", "http://cheap.net/free", "http://cheap.net/cheap-cheap",
    "http://x.net?a=://y.org/es/", "ftp://u:p@x.org:80/es/#frag", "http://x.org?/es/", "http://x.net/free_bets#win", "http://x.net/" + "a/" * 20000 + "porn",
    "http://ÉXAMPLE.org/es/", "http://x.net/éporn", "http://x.net/line\nporn", "http://x.com/fr/\nx?y",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(raw):])[0]
        host = raw.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    best = None
    for kind, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, kind)
    low = (url or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    hits = [sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in terms) for terms in (U.STRICT, U.SOFT)]
    verdict = best[1] if best else "block" if hits[0] or hits[1] >= U.MIN_SOFT else "allow"
    return host, path, best and best[0], verdict, hits[0], hits[1]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(URLS)], "page_id bigint, url string, html string, host string")


def test_against_brute_force(spark, pages):
    got = {r["page_id"]: tuple(r.values())[1:] for r in collected(U.judged(pages.unionByName(pages.limit(3))))}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}


def test_sql_agrees(spark, pages):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    assert sorted(map(str, con.execute(U.judged_sql()).fetchall())) == sorted(map(str, map(tuple, U.judged(pages).collect())))


def test_test_pages_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {r["page_id"]: brute(r["url"]) for r in pages.collect()}
    assert {r["page_id"]: tuple(r.values())[1:] for r in collected(U.judged(pages))} == want


def test_own_terms_and_empty(spark, pages):
    got = {r["page_id"]: r["verdict"] for r in collected(U.judged(pages, rules=(), strict=("fine",), soft=("de", "com"), min_soft=2))}
    assert got[10] == "block" and got[11] == "block" and got[9] == "allow"
    assert U.judged(pages.limit(0)).collect() == []

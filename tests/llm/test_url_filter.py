import re

import duckdb

from kpiloom.llm import url_filter
from kpiloom.llm.url_filter import RULES


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_canonical(url):
    host, path = brute_parts(url)
    query = re.match(r"(?s).*?://[^?#]*\?([^#]*)", url or "")
    params = sorted(p for p in (query[1] if query else "").split("&") if p and not re.match(r"(utm_[^=]*|ref|fbclid|gclid)(=|$)", p))
    return re.sub(r"^(www|m)\.", "", host) + re.sub("/+$", "", path) + ("?" + "&".join(params) if params else "")


def brute(url, listed):
    host, path = brute_parts(url)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fit, key=lambda r: len(r.name), default=None)
    return host, path, rule and rule.name, rule.verdict if rule else ("block" if brute_canonical(url) in listed else "allow")


URLS = [None, "", "no scheme", "http://", "https://Example.ORG/en/1?x", "http://a.example.org/en/2", "http://notexample.org/es/", "http://x.example.org/es/a",
        "http://org", "http://org/", "ftp://A.com/fr/x", "http://a.com/de/#f", "http://a.com?de/", "http://a.com/DE/", "a://b://c/d", "http://ÄB.net/é",
        "http://www.spam.net/p/?b=2&a=1&utm_x=1", "http://spam.net/p?a=1&b=2#z", "https://m.spam.net/p//?b=2&a=1&ref=9", "http://spam.net/p?a=1", "x\ny://h/p\nq"]


def test_edge_cases_against_brute_force(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS)] + [(None, URLS[4], "h", 1), (3, URLS[3], "h", 1), (3, URLS[3], "h", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, canonical int")
    listed_urls = ["http://spam.net/p?b=2&a=1", "http://spam.net/p?b=2&a=1", None, "nothing", "http://a.com/de/"]
    listed = spark.createDataFrame([(u,) for u in listed_urls], "url string")
    got = sorted(map(tuple, url_filter.judge(pages, listed).collect()), key=repr)
    known = {brute_canonical(u) for u in listed_urls} - {""}
    assert got == sorted(((r[0], *brute(r[1], known)) for r in rows), key=repr)
    assert url_filter.judge(pages.filter("false"), listed).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, listed.filter("false")).filter("rule is null").collect()} == {"allow"}


def test_false_positives_are_removed(spark):
    listed = spark.range(0, 500).selectExpr("concat('http://l.net/', id) as url")
    pages = spark.range(0, 1000).selectExpr("id as page_id", "concat('https://www.l.net/', id, '/') as url")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, listed, max_blocks=1).collect()}  # one block for all: nearly everything is a possible hit
    assert got == {i: "block" if i < 500 else "allow" for i in range(1000)}


def test_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = con.execute(url_filter.ORACLE).fetchall()
    got = [tuple(r) for r in url_filter.op4_bloom_url_filter(spark, sf).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}

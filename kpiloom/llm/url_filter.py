"""URL filter: host and path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The filter (``bloom.py``) is a broadcast table of bounded size, whatever the
list; a longer list only raises the share of false positives.  The possible
hits alone go on to an exact join with the list, which takes the false positives out.  A URL that
many pages share is no problem there: the list has one row a URL, and the
join's other side can be split.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  The canonical
form drops the scheme, a leading ``www.`` or ``m.``, slashes at the path's
end, the fragment and tracking parameters, and sorts the other parameters.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is on no list: it is allowed.  Equal URLs and repeated rows are
judged alike; other columns of the input are ignored; an empty table gives an
empty result and an empty list blocks nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.bloom import MAX_BLOCKS, probed
from kpiloom.llm.common import ascii_lower, table, written


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query, and the host names whose pages it lists.
RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))
LISTED_HOSTS = "casino|pills|bets|poker|loans"

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"
_TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form of a URL; empty where it has no ``://``."""
    kept = F.array_sort(F.filter(F.split(F.coalesce(F.regexp_extract(url, _QUERY, 1), F.lit("")), "&", -1),
                                 lambda p: (p != "") & ~p.rlike(_TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), F.regexp_replace(path_of(url), "/+$", ""), query)


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null.  The rules
    are a parameter of the query, few enough to stand in one expression."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def listed_in(rows: DataFrame, listed: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with the column ``listed``: whether ``key`` is on the list
    (one column of that name, no repeats), by filter and exact join."""
    found = probed(rows, listed, key, max_blocks)
    sure = found.filter("not _possible").withColumn("listed", F.lit(False))
    hits = (found.filter("_possible").join(listed.select(key, F.lit(True).alias("listed")), key, "left")
            .withColumn("listed", F.coalesce("listed", F.lit(False))))
    return sure.unionByName(hits).select(*rows.columns, "listed")


def judge(pages: DataFrame, listed_urls: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id",
          url: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.  ``listed_urls``: the
    blocked URLs, one column ``url``, as found (they are made canonical here)."""
    listed = written(listed_urls.select(canonical(F.col("url")).alias("canonical")).filter("canonical != ''").distinct(), "listed-urls")
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    own = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                     canonical(F.col("url")).alias("canonical"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = own.withColumn("rule", rule).withColumn("verdict", verdict)
    ruled = own.filter("rule is not null")
    rest = (listed_in(own.filter("rule is null"), listed, "canonical", max_blocks)
            .withColumn("verdict", F.when(F.col("listed"), "block").otherwise("allow")))
    out = ["page_id", "host", "path", "rule", "verdict"]
    return ruled.select(*out).unionByName(rest.select(*out))


def op4_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, pages.filter(host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url"))


ORACLE = f"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
         list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), ''), '&'),
                               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM pages),
keyed AS (
  SELECT page_id, host, path,
         regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
           || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical
  FROM parts),
listed AS (SELECT DISTINCT canonical FROM keyed WHERE regexp_matches(host, '{LISTED_HOSTS}') AND canonical <> ''),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM keyed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IN ('com/fr/', 'org/') THEN 'allow'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

"""URL filters: rules by host and path, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks of eight 32-bit words, one bit of each word per URL.  A page probes one block by a broadcast
hash join; only possible hits go on to the exact hash join with the list, so nothing is blocked by a false positive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common
from tidewatch.session import cut_lineage

#: Most blocks of a filter, so that its broadcast side is bounded: 2 ** 17 rows of one long and eight ints.  A longer list raises the share of
#: false positives, which the exact join removes.
MAX_BLOCKS = 1 << 17
URLS_PER_BLOCK = 16

# The rules of the query, as host + path, longest match first.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(df: DataFrame, url: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with host, path and canonical of a URL, each step of them computed once.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there up to ``?``, ``#`` or the end; both
    empty for a null URL or one without ``://``, whose canonical form is null.  Canonical: host without www., m. and default port; path
    without closing slashes and .html; query without tracking parameters, sorted; no fragment.
    """
    whole, at = common.whole(F.col(url)), F.locate("://", common.whole(F.col(url)))
    rest = df.select(*keep, (at > 0).alias("__known"), F.when(at > 0, F.substring(whole, at + 3, F.length(whole)))
                     .otherwise(F.lit("")).alias("__rest"))
    parts = rest.select(*keep, "__known", F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), _UPPER, _LOWER).alias("host"),
                        F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
                        F.split(F.regexp_extract("__rest", r"^[^?#]*\?([^#]*)", 1), "&").alias("__asked"))
    query = F.array_join(F.array_sort(F.filter(
        "__asked", lambda p: (p != "") & ~p.rlike(r"^(?:utm_[a-z]*|ref)(?:=|$)"))), "&")
    site = F.regexp_replace(F.regexp_replace("host", r"^(?:www\.|m\.)+", ""), r":(?:80|443)$", "")
    forms = parts.select(*keep, "__known", "host", "path", site.alias("__site"),
                         F.regexp_replace("path", r"(?:\.html)?/*$", "").alias("__place"), query.alias("__query"))
    asked = F.when(F.col("__query") == "", "").otherwise(F.concat(F.lit("?"), "__query"))
    return forms.select(*keep, "host", "path", F.when(F.col("__known"), F.concat("__site", "__place", asked)).alias("canonical"))


def rule(host_col: Column, path_col: Column, rules) -> Column:
    """The longest (kind, pattern) that fits as a struct, null if none does.  The rules are a short list given by the caller; of two equally
    long ones the longer host wins."""
    parted = [(kind, text, *text.split("/", 1)) for kind, text in rules]
    hit = F.lit(None).cast("struct<kind:string,rule:string>")
    for kind, text, site, rest in sorted(parted, key=lambda r: (len(r[1]), len(r[2]))):
        fits = ((host_col == site) | host_col.endswith("." + site)) & path_col.startswith("/" + rest)
        hit = F.when(fits, F.struct(F.lit(kind).alias("kind"), F.lit(text).alias("rule"))).otherwise(hit)
    return hit


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("bigint")


def _bits(key: Column) -> list[Column]:
    second = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(second, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(8)]


def bloom(listed: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The filter's blocks that have a bit set, and the number of blocks; ``listed`` has one column, key."""
    blocks = min(MAX_BLOCKS, max(1, -(-n // URLS_PER_BLOCK)))
    table = listed.groupBy(_block(F.col("key"), blocks).alias("block")).agg(
        *[F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(_bits(F.col("key")))])
    return table, blocks


def blocked(pages: DataFrame, listed_urls: DataFrame, rules=RULES, block_list: str = "url") -> DataFrame:
    """Every page (page_id, url) with host, path, canonical, rule and verdict.

    The longest fitting rule decides; without one a page is blocked if its canonical URL is one of the canonical forms of ``listed_urls``.
    Null URLs and URLs without ``://`` have empty host and path, are never listed and are allowed.  Repeated pages are judged row by row; an
    empty list blocks nothing; an empty table gives no rows; further columns are ignored.  A hot URL is one key of the exact join, whose other
    side has it once, so adaptive execution splits it.
    """
    listed = cut_lineage(parsed(listed_urls, block_list, []).select(F.col("canonical").alias("key")).filter("key is not null").distinct())
    table, blocks = bloom(listed, listed.count())
    table = cut_lineage(table)
    judged = parsed(pages, "url", ["page_id"])
    judged = judged.withColumn("hit", rule(F.col("host"), F.col("path"), rules))
    probe = judged.withColumn("block", F.when(F.col("hit").isNull(), _block(F.col("canonical"), blocks)))
    probe = probe.join(F.broadcast(table), "block", "left")
    sure = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(bit) != 0 for i, bit in enumerate(_bits(F.col("canonical")))])
    maybe = F.col("hit").isNull() & F.col("canonical").isNotNull() & F.coalesce(sure, F.lit(False))
    columns = ["page_id", "host", "path", "canonical", F.col("hit.rule").alias("rule")]
    passed = probe.filter(~maybe).select(*columns, F.coalesce("hit.kind", F.lit("allow")).alias("verdict"))
    exact = probe.filter(maybe).join(listed.select("key", F.lit(True).alias("on_list")), F.col("canonical") == F.col("key"), "left")
    return passed.unionByName(exact.select(*columns, F.when(F.col("on_list"), "block").otherwise("allow").alias("verdict")))


def thin(pages: DataFrame, words: int = 160) -> DataFrame:
    """URLs of pages with fewer words of markup and text than that: the list of the query."""
    return pages.filter(common.n_words(F.col("html")) < words).select("url")


def query(spark, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    return blocked(pages, thin(pages)).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH parts AS (
    SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
           coalesce(strpos(url, '://') > 0, false) AS known
    FROM pages),
split AS (
    SELECT page_id, html, known, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS asked
    FROM parts),
canon AS (
    SELECT *, CASE WHEN known THEN
             regexp_replace(regexp_replace(host, '^(?:www\.|m\.)+', ''), ':(?:80|443)$', '') || regexp_replace(path, '(?:\.html)?/*$', '')
             || CASE WHEN kept = '' THEN '' ELSE '?' || kept END END AS canonical
    FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(string_split(asked, '&'),
                 lambda p: p <> '' AND NOT regexp_matches(p, '^(?:utm_[a-z]*|ref)(?:=|$)'))), '&'), '') AS kept FROM split)),
listed AS (
    SELECT DISTINCT canonical AS key FROM canon
    WHERE canonical IS NOT NULL AND len(regexp_extract_all(coalesce(html, ''), '[^\x20\x09-\x0D]+')) < 160),
ruled AS (
    SELECT *, CASE
        WHEN host = 'www.example.com' OR host LIKE '%.www.example.com' THEN CASE WHEN path LIKE '/en/%' THEN 'www.example.com/en/' WHEN path LIKE '/%' THEN 'com/' END
        WHEN host = 'example.com' OR host LIKE '%.example.com' THEN CASE WHEN path LIKE '/en/%' THEN 'example.com/en/' WHEN path LIKE '/%' THEN 'com/' END
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/' END AS rule
    FROM canon)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canonical IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

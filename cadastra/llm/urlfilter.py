"""URL filter: rules on host and path, and a list of canonical URLs behind a blocked Bloom filter.

A rule fits a URL when the rule's host is the URL's host or a parent domain of it and the URL's path
starts with the rule's path; the longest rule that fits decides.  URLs that no rule fits are looked
up in the list: the Bloom filter lets possible hits through, and an exact join on the canonical URL
removes the false positives.

The filter is split into blocks of four 64-bit words; a URL sets one bit in each word of one block,
so a probe touches a single block.  It is built by ``bit_or`` per block (map-side combined, mergeable)
and has at most ``max_blocks`` rows of 40 bytes, whatever the length of the list: that bound is what
allows it to be broadcast.  A longer list only lets more candidates through to the exact join.

Scale.  Only the URL column is read.  Definite misses never shuffle; possible hits are joined with
the list by canonical URL (Spark splits a hot key's partition, since no aggregate needs it whole).
Up to ``literal_rules`` rules are compiled into one expression; more are joined by host suffix, with
the same result.

Ties.  Of rules of equal length the one first in order of host, path and verdict decides.

Edge cases.  A null URL, or one without ``://``, has an empty host and path, fits no rule and is
never listed: allow.  Repeated rows are judged one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm.decontaminate import ascii_lower

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: op3 lists the URLs whose MD5, in hex, begins with this digit: about one in sixteen, whatever the words in them.
LISTED_DIGIT = "0"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or default port, path without a trailing slash, sorted query without
    tracking parameters, no scheme and no fragment; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(r"^(utm_\w+|ref|fbclid|gclid)(=|$)")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _precedence(rule: tuple[str, str, str]) -> tuple:
    """Longest first; ties by the bytes of host, path and verdict, as Spark orders strings."""
    return -len(rule[0] + rule[1]), *[part.encode() for part in rule]


def _literal_rule(host: Column, path: Column, rules) -> Column:
    out = None
    for h, p, verdict in sorted(rules, key=_precedence):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _joined_rule(urls: DataFrame, rules) -> DataFrame:
    table = urls.sparkSession.createDataFrame([(h, p, h + p, v) for h, p, v in rules], "rhost string, rpath string, rule string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (
        urls.select("rid", "path", F.explode(F.array_distinct(suffixes)).alias("rhost"))
        .join(table, "rhost")
        .where(F.col("path").startswith(F.col("rpath")))
        .groupBy("rid")
        .agg(F.min_by(F.struct("rule", "verdict"), F.struct(-F.length("rule"), "rhost", "rpath", "verdict")).alias("hit"))
    )
    return urls.join(fits, "rid", "left")


def _bits(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(F.lit("bloom"), key)
    one = F.lit(1).cast("long")
    # one bit of each word, taken from its own six bits of the hash
    words = [F.call_function("shiftleft", one, F.pmod(F.shiftright(h, 12 * i), F.lit(64)).cast("int")) for i in range(4)]
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)), words


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """``block``, ``w0``..``w3`` of the filter over the column ``key``."""
    block, words = _bits(F.col(key), n_blocks)
    return listed.select(block.alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(words)]).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    *,
    rules=RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    bits_per_url: int = 16,
    max_blocks: int = 1 << 20,
    literal_rules: int = 200,
) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule``, ``listed``, ``verdict`` (allow or block)."""
    exact = rt.materialize(listed.select(canonical(F.col(listed_col)).alias("c")).where(F.col("c").isNotNull()).distinct(), "listed")
    n_blocks = max(1, min(max_blocks, exact.count() * bits_per_url // 256))
    blocks = rt.materialize(bloom_blocks(exact, "c", n_blocks), "bloom")
    url = F.col("url")
    urls = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = urls.select("rid", "id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("c"))
    urls = urls.withColumn("hit", _literal_rule(F.col("host"), F.col("path"), rules)) if len(rules) <= literal_rules else _joined_rule(urls, rules)
    block, words = _bits(F.col("c"), n_blocks)
    probed = urls.withColumn("block", block).join(F.broadcast(blocks), "block", "left")
    maybe = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(w) == w for i, w in enumerate(words)])
    probed = probed.withColumn("maybe", F.coalesce(maybe & F.col("hit").isNull(), F.lit(False))).select("id", "host", "path", "hit", "c", "maybe")
    sure = probed.where(~F.col("maybe")).select("id", "host", "path", "hit", F.lit(False).alias("listed"))
    held = rt.maybe_broadcast(exact.withColumn("in", F.lit(True)), 160)
    checked = probed.where("maybe").join(held, "c", "left").select("id", "host", "path", "hit", F.coalesce("in", F.lit(False)).alias("listed"))
    both = sure.unionByName(checked)
    return both.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        "listed",
        F.coalesce("hit.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def sample_list(pages: DataFrame) -> DataFrame:
    """The list that op3 filters by.  The tables hold none, so URLs are drawn by their hash and listed
    in another spelling (``www.``, upper case, a fragment): only their canonical form meets the pages'."""
    url = F.col("url")
    drawn = pages.select("url").where(F.substring(F.md5(url.cast("binary")), 1, 1) == LISTED_DIGIT)
    return drawn.select(F.concat(F.regexp_replace(url, r"(?s)^(.*?)://(?i:www\.)?", "$1://WWW."), F.lit("#listed")).alias("url"))


def op3(spark, sf_dir: str) -> DataFrame:
    pages = rt.table(spark, sf_dir, "pages")
    return filter_urls(pages, sample_list(pages)).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\?([^#]*)', 1) AS query
  FROM pages),
c AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') || '?' ||
         array_to_string(list_sort(list_filter(string_split(query, '&'), lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_\w+|ref|fbclid|gclid)(=|$)'))), '&') AS canon
  FROM p),
listed AS (SELECT DISTINCT canon FROM c WHERE host <> '' AND starts_with(md5(url), '0')),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
            ELSE CASE WHEN host <> '' AND canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END END AS verdict
FROM r
"""

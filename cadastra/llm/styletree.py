"""Main-text extraction with a site style tree.

The block elements of every page are merged, host by host, into one tree whose nodes are paths of
element names (tag, class, id).  A node with children has *presentation styles*, the orders in which
its children occur; a text node has *content features*, its texts with the host's name and digits
masked.  Over the m pages that hold a node,

* presentation importance is the entropy, to the base m, of its styles;
* content importance is one minus the mean entropy of its features over pages: a text found on
  every page contributes 1 to the mean, a text of one page contributes 0;
* a node's composite importance blends its own with its children's, weighted by ``damping`` to the
  number of styles.

A branch in which nothing reaches ``least`` is noise and is removed from each page.  Entropy says
little about a host with few pages, so all hosts together form a second tree: a branch must be
important in both (each where it has ``min_pages``).  What a page author names as furniture (nav,
footer, aside, form, class "ad", "comments", ...) has importance 0 from the start: reader comments,
say, are different on each page, which entropy alone takes for content.  Where a page has article
elements with text, only those are searched, and if entropy leaves nothing of them they stay whole.

Scale.  Pages are parsed twice (statistics, extraction).  For the statistics html is shuffled once,
since copies of a page on its host count as one page.  For the extraction it is not shuffled while
the noise table fits a broadcast; beyond that pages and noise meet in a join by host.  Statistics are combined
per task and map-side; the table per host holds only distinct paths.

Edge cases.  Null or empty html gives empty text.  Broken markup is read as far as it goes.  A null
URL belongs to the empty host.  Repeated rows are extracted one by one.  Nothing is cut or dropped
by length.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm.urlfilter import host_of

#: Elements that start a block of text of their own.
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table caption thead tbody tfoot tr td th"
    " header footer nav aside form fieldset address details summary hr center hgroup search dialog menu".split()
)
#: Elements whose content is never text of the page.
RAW = "script|style|noscript|template|title|textarea|iframe|svg|math|select|object|audio|video|canvas|button|head"
#: Elements that are furniture by definition.
FURNITURE_TAGS = frozenset("nav footer aside form menu search dialog fieldset".split())
#: Words that mark furniture as a whole class token or id, or as its first or last word.
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu header masthead topbar banner footer sidebar aside rail ad ads advert advertisement adverts adsense sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended"
    " recommendations comment comments commentlist discussion disqus replies reply respond breadcrumb breadcrumbs pagination pager toolbar widget login search form".split()
)
#: Words that say a "header" is the article's own.
OWN_WORDS = frozenset("article entry post story title content body headline".split())
#: Words of a layout state: "has-sidebar" and "comments-open" tell of furniture elsewhere.
STATE_WORDS = frozenset("has have with without no not is are hide hides show shows on off open opened closed active inactive enabled disabled visible hidden collapsed expanded".split())
#: Elements that hold the page's own text whatever their names say.
OWN_TAGS = frozenset("html body main article".split())
#: A start tag of the first closes an open element of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:.*?</\1\s*>|.*)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_HEAD_OPEN = re.compile(r"<head(?=[\s/>])", re.I)
_HEAD_CLOSE = re.compile(r"</head\s*>|<body(?=[\s/>])", re.I)
_CLASS = re.compile(r"""(?:^|\s)(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_DIGITS = re.compile(r"\d+")
_names: dict[tuple[str, str], tuple[str, bool]] = {}


def _name(tag: str, attrs: str) -> tuple[str, bool]:
    """Node name of an element and whether its own names mark it as furniture."""
    known = _names.get((tag, attrs))
    if known is None:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _CLASS.finditer(attrs)}
        furniture = tag in FURNITURE_TAGS or tag not in OWN_TAGS and _furnished([t for v in found.values() for t in v.split()])
        name = tag + "".join("." + c for c in sorted(found.get("class", "").split())) + ("#" + found["id"] if found.get("id") else "")
        known = (_DIGITS.sub("0", name).replace("/", "_"), furniture)
        if len(_names) < 50_000:
            _names[tag, attrs] = known
    return known


def _furnished(tokens: list[str]) -> bool:
    """Whether class tokens and id name furniture.  A compound does so by its first or last word, unless
    it tells a state or another token is the plain name of the page's own text."""
    split = [[w.lower() for w in _WORD.findall(t)] for t in tokens]
    plain = {w[0] for w in split if len(w) == 1}
    ends = {w for x in split if x and not STATE_WORDS & set(x) for w in (x[0], x[-1])} if not plain & OWN_WORDS else plain
    words = {w for x in split for w in x}
    return bool(ends & FURNITURE_WORDS) and not (words & OWN_WORDS and not ends & (FURNITURE_WORDS - {"header", "banner"}))


class Page:
    """Blocks of a page in order and, per path, the order of its children."""

    __slots__ = ("blocks", "styles")

    def __init__(self):
        self.blocks: list[tuple[str, str, bool, bool]] = []  # path, text, furniture, inside an article
        self.styles: dict[str, list[str]] = {}


def parse(html: str) -> Page:
    page, text, at = Page(), [], 0
    # open block elements: tag, path, furniture, inside an article
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
    head = _HEAD_OPEN.search(html)
    if head:  # an unclosed head ends where the body begins
        close = _HEAD_CLOSE.search(html, head.end())
        html = html[: head.start()] + (html[close.end() if html[close.start() + 1] == "/" else close.start() :] if close else "")

    def flush() -> None:
        if text:
            joined = "".join(text)
            text.clear()
            words = (html_lib.unescape(joined) if "&" in joined else joined).split()
            if words:
                _, path, furniture, inside = stack[-1]
                page.blocks.append((path, " ".join(words), furniture, inside))
                _child(page, path, "#text")

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            text.append(html[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            if m[1]:
                text.append(" ")
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if m[2] or m[5]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if stack[-1][0] == "p":
            stack.pop()
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in CLOSES.get(tag, ()):
                del stack[k:]
                break
            if stack[k][0] not in ("p", "div", "span", "tr", "td", "th"):
                break
        if tag == "hr":
            continue
        _, parent, furniture, inside = stack[-1]
        name, marked = _name(tag, m[4] or m[7] or "")
        if tag == "header" and not inside:
            marked = True
        path = f"{parent}/{name}"
        _child(page, parent, name)
        stack.append((tag, path, furniture or marked, inside or tag in ("article", "main")))
    if at < len(html):
        text.append(html[at:])
    flush()
    return page


def _child(page: Page, parent: str, name: str) -> None:
    order = page.styles.setdefault(parent, [])
    if not order or order[-1] != name:  # a run of equal children is one step of the style
        order.append(name)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _stat_batches(batches):
    """(host, path, kind, feature, pages): kind 0 presence, 1 style, 2 content feature."""
    counts: dict[tuple, int] = {}

    def out() -> pa.RecordBatch:
        host, path, kind, feature = zip(*counts, strict=True) if counts else ((), (), (), ())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(kind, pa.int32()), pa.array(feature, pa.int64()), pa.array(list(counts.values()), pa.int64())],
            names=["host", "path", "kind", "feature", "pages"],
        )
        counts.clear()
        return batch

    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not html:
                continue
            page, own = parse(html), set()
            for parent, order in page.styles.items():
                own.add((host, parent, 0, 0))
                own.add((host, parent, 1, _hash("|".join(order))))
            for path, text, _, _ in page.blocks:
                masked = _DIGITS.sub("0", text.replace(host, "\0") if host else text)
                own.add((host, path + "/#text", 0, 0))
                own.add((host, path + "/#text", 2, _hash(masked)))
            for key in own:
                counts[key] = counts.get(key, 0) + 1
        if len(counts) > 200_000:
            yield out()
    yield out()


def _composite(damping: float):
    """Composite importances of the nodes of one tree, children before parents."""

    def run(tree: pd.DataFrame) -> pd.DataFrame:
        rows = {p: (m, own, n) for p, m, own, n in zip(tree.path, tree.pages, tree.own, tree.styles, strict=True)}
        children: dict[str, list[str]] = {}
        for path in rows:
            if path:
                children.setdefault(path.rpartition("/")[0], []).append(path)
        value, peak = {}, {}
        for path in sorted(rows, key=lambda p: -p.count("/")):
            m, own, n = rows[path]
            kids = children.get(path, [])
            if kids and not path.endswith("/#text"):
                weight = sum(rows[k][0] for k in kids)
                mean = sum(value[k] * rows[k][0] for k in kids) / weight
                value[path] = (1 - damping**n) * own + damping**n * mean
            else:
                value[path] = own
            peak[path] = max([value[path], *(peak[k] for k in kids)])
        return pd.DataFrame({"host": tree.host, "path": tree.path, "pages": tree.pages, "importance": tree.path.map(value), "peak": tree.path.map(peak)})

    return run


def style_tree(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", damping: float = 0.9) -> DataFrame:
    """Nodes of all trees: ``host`` (null for the tree of all hosts), ``path``, ``pages``,
    ``importance`` (composite) and ``peak`` (highest composite in the branch)."""
    src = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    # a page counts once, however many copies of it the host has
    counted = src.where(F.length("html") > 0).distinct().mapInArrow(_stat_batches, "host string, path string, kind int, feature long, pages long")
    by_host = rt.materialize(counted.groupBy("host", "path", "kind", "feature").agg(F.sum("pages").alias("pages")), "styles")
    everywhere = by_host.groupBy("path", "kind", "feature").agg(F.sum("pages").alias("pages")).withColumn("host", F.lit(None).cast("string"))
    both = by_host.unionByName(everywhere)
    keys = ["host", "path"]
    total = both.where("kind = 0").select(*keys, F.col("pages").alias("m"))
    k, log_k = F.col("pages"), F.log(F.col("pages"))
    features = both.where("kind > 0").groupBy(*keys, "kind").agg(F.sum(k).alias("sum"), F.sum(log_k).alias("logs"), F.sum(k * log_k).alias("plogs"), F.count("*").alias("n"))
    t = total.withColumnRenamed("host", "th").withColumnRenamed("path", "tp")
    joined = features.join(t, features["path"].eqNullSafe(t["tp"]) & features["host"].eqNullSafe(t["th"]))
    # styles: -sum p log_m p with p = k / m; features: 1 - mean log_m k; both 1 for a single page
    presence = (F.log("m") - F.col("plogs") / F.col("m")) / F.log("m")
    content = 1 - F.col("logs") / F.col("n") / F.log("m")
    own = F.when(F.col("m") <= 1, 1.0).when(F.col("kind") == 1, presence).otherwise(content)
    nodes = joined.select("host", "path", F.col("m").alias("pages"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), own)).alias("own"), F.when(F.col("kind") == 1, F.col("n")).otherwise(0).cast("long").alias("styles"))
    schema = "host string, path string, pages long, importance double, peak double"
    return nodes.groupBy("host").applyInPandas(_composite(damping), schema)


def text_of(html: str | None, noise: frozenset | set = frozenset()) -> str:
    """Main text of a page: its blocks without furniture and without the noise paths."""
    if not html:
        return ""
    blocks = parse(html).blocks
    inside = any(x[3] and not x[2] for x in blocks)
    found = [(path, text) for path, text, furniture, own in blocks if not furniture and (own or not inside)]
    left = [x for x in found if x[0] + "/#text" not in noise]
    return "\n".join(text for _, text in (left if left or not inside else found))


def _extract_batches(batches):
    for batch in batches:
        out = [text_of(html, set(noise or ())) for html, noise in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["id", "url", "text"])


def _extract_shared(shared):
    def run(batches):
        by_host, everywhere = shared.value
        for batch in batches:
            hosts, pages = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            out = [text_of(html, everywhere | by_host.get(host, frozenset())) for host, html in zip(hosts, pages, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["id", "url", "text"])

    return run


def extract_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: float = 0.4, min_pages: int = 8, damping: float = 0.9, broadcast_bytes: int = 16 << 20
) -> DataFrame:
    """Per row: id, url, ``text``, ``n_chars``."""
    spark = pages.sparkSession
    tree = style_tree(pages, url_col=url_col, html_col=html_col, damping=damping)
    noise = rt.materialize(tree.where((F.col("peak") < least) & (F.col("pages") >= min_pages) & F.col("path").endswith("/#text")).select("host", "path"), "noise")
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    schema = f"id {dict(src.dtypes)['id']}, url string, text string"
    if rt.fits_broadcast(noise, 256, broadcast_bytes):
        by_host: dict[str | None, set] = {}
        for r in noise.collect():
            by_host.setdefault(r.host, set()).add(r.path)
        everywhere = frozenset(by_host.pop(None, ()))
        shared = spark.sparkContext.broadcast(({h: frozenset(x) for h, x in by_host.items()}, everywhere))
        out = src.mapInArrow(_extract_shared(shared), schema)
    else:
        overall = noise.where(F.col("host").isNull()).agg(F.collect_set("path").alias("all"))
        own = noise.where(F.col("host").isNotNull()).groupBy(F.col("host").alias("h")).agg(F.collect_set("path").alias("own"))
        joined = src.join(own, src["host"] == own["h"], "left").crossJoin(F.broadcast(overall))  # one row
        both = F.array_union(F.coalesce("own", F.array().cast("array<string>")), F.col("all"))
        out = joined.select("id", "url", "html", both.alias("noise")).mapInArrow(_extract_batches, schema)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


def op2(spark, sf_dir: str) -> DataFrame:
    return extract_text(rt.table(spark, sf_dir, "pages"))

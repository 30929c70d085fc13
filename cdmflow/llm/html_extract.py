"""Main text of web pages with a site style tree.

All pages of a host are merged into one tree: its nodes are the element paths (tag and class) under which
blocks of text stand. A node's importance is the entropy of what the host's pages show there: contents
spread evenly over the pages carry information (towards 1), the same content on every page does not
(towards 0). Every branch of every page enters the tree, presentation and marked articles included. The entropy
over n pages counts n - 1 times against once what the page's own markup says of the branch (to be kept, or not), so
that evidence outweighs markup gradually and one page alone decides nothing.

From each page go: branches that are presentation by their nature (menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts, styles; by tag, role, class or id), and branches whose
importance is below ``least``. Where a page marks its article (``article``, ``main``), the branches inside stand
for the page, whatever their importance (copies of an article on many pages of a host are still articles), and
of the others those whose importance is known and reaches ``least``. Class words count as whole words or known
prefixes; other words that hold one (``entry-comments``) leave their branch inside an article to its importance.

On Spark: two parsing passes in ``mapInPandas`` around one aggregation. Contents enter the tree as 64-bit
hashes; (host, path, content) counts are summed before the shuffle and again to (host, path), so a host
with a third of all pages is no hot group, and no page text is shuffled for the tree. The nodes are joined to
the branches, and the branches to change to the pages by page; both are broadcast only up to ``BROADCAST`` rows.

Defined cases: a null or empty page has an empty text; a null URL belongs to the host ''; broken markup
(unclosed elements, stray ends) closes at the next block; repeated rows are extracted one by one; an empty
table gives an empty result; other columns of the input are not read. Whole pages are read, whatever their
length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmflow.llm.common import stage

BROADCAST = 100_000

# Elements of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small "
             "span strike strong sub sup time tt u var wbr br img "
             "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mstyle semantics".split())
BOILERPLATE = set("nav header footer aside menu dialog button".split())
ARTICLE = {"article", "main"}
# Whole words of class, id and role that mark presentation.
NOISE = set("ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promotion menu nav "
            "navbar navigation breadcrumb breadcrumbs sidebar side widget widgets related recommended share sharing social "
            "cookie cookies consent notice notices popup modal overlay newsletter subscribe subscription signup login "
            "header masthead footer toolbar pagination pager comment comments respond replies disqus contentinfo "
            "complementary search".split())
# Of these, the ones that mark it as the first part of a word too (``ad-slot``), unless a part of
# STATE makes the word a condition of the page (``comments-open``, ``side-by-side``).
PREFIXES = set("ad ads advert adverts advertisement advertising banner banners sponsor sponsored menu nav navbar navigation "
               "breadcrumb breadcrumbs sidebar widget widgets share sharing social cookie cookies consent popup modal overlay "
               "newsletter subscribe subscription masthead footer toolbar pagination pager comment comments respond replies "
               "disqus related recommended".split())
STATE = set("has no not with without by is on off open opened closed close enabled disabled hidden less free none".split())

# A tag ends at the next ``<`` outside quotes, so tags that never close are passed over one by one; the last
# alternative takes those, and tags with an unclosed quote, for markup without meaning.
_ATTRS = r"(?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,2000}+\"|'[^']{0,2000}+')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    rf"|<svg(?=[\s/]){_ATTRS}(?<=/)>"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|annotation|iframe|object|select|title|canvas|audio|video)(?=[\s/>])"
    rf"{_ATTRS}>.*?(?:</(?P=raw)\s*>|$)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>{_ATTRS})>"
    r"|</?[a-zA-Z][^\s<>]*(?:\s[^<>]*)?(?:>|(?=<)|$)", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_PART = re.compile(r"[^a-z]+")


def host_of(url: str | None) -> str:
    _, found, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower() if found else ""


def _word_says(word: str, in_article: bool) -> str | None:
    """'noise', 'doubt' or None of one whole word of a class or id."""
    if word in NOISE:
        return None if word == "header" and in_article else "noise"
    parts = [x for x in _PART.split(word) if x]
    if len(parts) > 1 and parts[0] in PREFIXES and STATE.isdisjoint(parts):
        return "noise"
    found = NOISE.intersection(parts)
    return "doubt" if found and not (in_article and found == {"header"}) else None


def _described(tag: str, attrs: str, in_article: bool = False) -> tuple[str, bool, set]:
    """(path step, is presentation by tag, role or style, what its class and id say) of an element."""
    step, noise, says = tag, tag in BOILERPLATE, set()
    if attrs and not attrs.isspace():
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name == "role":
                noise |= not NOISE.isdisjoint(value.split())
            elif name in ("class", "id"):
                says.update(_word_says(w, in_article) for w in value.split())
                step += "." + value.strip()
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                noise = True
    return step, noise, says


def blocks(page: str | None) -> list[tuple[str, str, bool, bool | None]]:
    """(path, text, presentation, in an article; None if in a doubtful branch of one) of the blocks of a page in
    order; no empty texts.

    Class words and forms never condemn the page's article, nor a branch that holds it: branches they condemn are
    taken back if they hold an article and no article stands outside them. A form that holds all there is to read
    (pages wrapped in one form) is taken back too."""
    out: list[tuple[str, str, bool, bool | None, tuple]] = []
    stack: list[tuple[str, str, bool, bool | None, tuple]] = []  # tag, path, presentation, in an article, condemned by class
    root = ("", "", False, False, ())
    parts: list[str] = []
    holders: set[int] = set()  # elements condemned by class words that hold an article
    forms: set[int] = set()
    number, free = 0, False

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, path, noise, article, words = stack[-1] if stack else root
                out.append((path, text, noise, article, words))

    def open_element(tag, attrs):
        nonlocal number, free
        _, path, noise, article, words = stack[-1] if stack else root
        inside = article is not False
        # the heading of an article belongs to it
        step, own, says = _described("div" if tag == "header" and inside else tag, attrs, inside)
        if tag == "body":
            own, says = False, set()
        elif tag in ARTICLE and not inside:
            says = set()
            if not noise and not own:
                holders.update(words)
                free |= not words
            article = True
        if "noise" in says or tag == "form":
            number += 1
            words = (*words, number)
            if "noise" not in says:
                forms.add(number)
        elif "doubt" in says and inside:
            article = None
        stack.append((tag, f"{path}/{step}", noise or own, article, words))

    at, text = 0, page or ""
    for m in _TOKEN.finditer(text):
        if m.start() > at:
            parts.append(text[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag in INLINE:
            continue
        elif m["end"]:
            flush()
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
        else:
            flush()
            while stack and stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or stack and stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
                stack.pop()
            if tag == "head":
                stack.append((tag, "/head", True, False, ()))
            elif tag == "body":
                stack.clear()
                open_element(tag, m["attrs"])
            elif tag not in VOID and not m["attrs"].endswith("/"):
                open_element(tag, m["attrs"])
    if at < len(text):
        parts.append(text[at:])
    flush()
    taken_back = set() if free else holders
    if all(noise or not taken_back.issuperset(words) for _, _, noise, _, words in out):
        taken_back = taken_back | forms
    return [(path, text, noise or not taken_back.issuperset(words), article) for path, text, noise, article, words in out]


def _marked(found: list) -> bool:
    return any(article is not False and not noise for _, _, noise, article in found)


def main_text(page: str | None, changed: frozenset = frozenset()) -> str:
    """The text of a page; ``changed`` has the branches where the tree decides against the page's own marking."""
    found = blocks(page)
    marked = _marked(found)
    return " ".join(text for path, text, noise, article in found
                    if not noise and (marked and article is False) == (path in changed))


def tree_rows(pages: DataFrame, html_col: str, url_col: str) -> DataFrame:
    """(page, host, path, content, open) of every branch of every page, and one row with a null path per page;
    ``content`` hashes the branch's texts; ``open`` is what importance may change: 'drop', 'keep' or null."""
    schema = "page long, host string, path string, content long, open string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, url, page in zip(pdf["page"], pdf["url"], pdf["html"]):
                found = blocks(page if isinstance(page, str) else None)
                marked = _marked(found)
                seen: dict[tuple, list[str]] = {}
                for path, text, noise, article in found:
                    way = None if noise or marked and article else "keep" if marked and article is False else "drop"
                    seen.setdefault((path, way), []).append(text)
                host = host_of(url if isinstance(url, str) else None)
                rows.append((key, host, None, 0, None))
                for (path, way), texts in seen.items():
                    value = xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "replace"))
                    rows.append((key, host, path, np.uint64(value).astype(np.int64), way))
            yield pd.DataFrame(rows, columns=["page", "host", "path", "content", "open"])

    return pages.select(_page_key(html_col, url_col), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInPandas(run, schema)


def _page_key(html_col: str, url_col: str):
    return F.xxhash64(F.col(url_col).cast("string"), F.col(html_col).cast("string")).alias("page")


def importance(rows: DataFrame) -> DataFrame:
    """(host, path, pages, importance): the entropy of a node's contents over the pages that show it, scaled to 1; null
    for a node of one page."""
    counts = rows.groupBy("host", "path", "content").agg(F.count(F.lit(1)).cast("double").alias("c"))
    node = counts.groupBy("host", "path").agg(F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("s"))
    entropy = (F.log("pages") - F.col("s") / F.col("pages")) / F.log("pages")
    return (node.filter(F.col("path").isNotNull())
            .select("host", "path", "pages", F.when(F.col("pages") > 1, entropy).alias("importance")))


def changes(rows: DataFrame, least: float) -> DataFrame:
    """(page, _change: the branches where the tree decides against the page's own marking)."""
    kept = lambda prior: (F.col("importance") * (F.col("pages") - 1) + prior) / F.col("pages") >= least
    nodes = stage(importance(rows).filter(F.col("importance").isNotNull())
                  .select("host", "path", (~kept(1)).alias("_poor"), kept(0).alias("_rich")).filter("_poor OR _rich"), "style-nodes")
    nodes = F.broadcast(nodes) if nodes.count() <= BROADCAST else nodes
    against = ((F.col("open") == "drop") & F.col("_poor")) | ((F.col("open") == "keep") & F.col("_rich"))
    return (rows.filter(F.col("open").isNotNull()).join(nodes, ["host", "path"]).filter(against)
            .groupBy("page").agg(F.collect_set("path").alias("_change")))


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", url_col: str = "url",
            least: float = 0.2) -> DataFrame:
    """(id, url, text) of every page."""
    rows = stage(tree_rows(pages, html_col, url_col), "style-tree")
    changed = stage(changes(rows, least), "changed")
    key = _page_key(html_col, url_col)
    taken = pages.select(F.col(id_col).alias(id_col), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("_html"), key)
    side = F.broadcast(changed) if changed.count() <= BROADCAST else changed
    joined = taken.join(side, "page", "left").drop("page")
    schema = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [main_text(p if isinstance(p, str) else None, frozenset(d) if isinstance(d, (list, np.ndarray)) else frozenset())
                     for p, d in zip(pdf["_html"], pdf["_change"])]
            yield pdf.drop(columns=["_html", "_change"]).assign(text=texts)

    return joined.mapInPandas(run, schema)

"""Main text of pages by a site style tree.

Pages of one host are merged into a tree: a node stands for an element under a path of tags and classes. Two
entropies tell how much a node matters on its site: how varied its presentation is over the pages that hold it, and
how varied its content is. A node that says the same on most pages of a site has a low entropy; branches of low
importance are removed from each page. Elements whose tag or role says that they are menus, adverts, forms and the
like never belong to the article, whatever their entropy. Class words do the same outside an article; inside one only
a class made of nothing but such words does, and the rest is left to the tree. What stands in an article or main
element under no class of its own (its paragraphs, headings and lists) is never removed for repeating: articles are
copied too.

The tree counts pages: what a node says on a page is all its blocks there together, and pages of a host with the same
blocks are one page. Pages without a host belong to no site; they stay out of the tree and lose nothing to it.

The tree is a pair of grouped counts by (host, node); no host's pages meet in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicator_lake.llm.html import END, START, TEXT, attributes, tokens
from indicator_lake.llm.tables import stored

MIN_PAGES = 8  # a node of fewer pages of a host says nothing about repetition
LOW_IMPORTANCE = 0.15
SHAPE = 0.1  # share of the presentation entropy in a node's importance

# What tags and class names mean in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea noscript template svg iframe".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form button select option dialog menu label head".split())
BLOCK_TAGS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th thead tbody tfoot caption section article main "
    "blockquote pre figure figcaption address br hr details summary".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb "
    "breadcrumbs header footer masthead sidebar aside widget related recommended share sharing social cookie cookies "
    "consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login comment comments "
    "discussion disqus reply replies form search pagination pager tags toolbar copyright legal skip".split()
)
REPLY_WORDS = frozenset("comment comments reply replies ad advert".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
CLOSED_BY = {
    "p": BLOCK_TAGS - {"br", "html", "body"},
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}), "head": BLOCK_TAGS,
}

_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

_NODES = "host string, row long, page long, node long, parent long, style long, content long, plain boolean"
_TEXTS = "page_id long, url string, row long, parts array<struct<node: long, text: string>>"


# What an element is to the article: part of it, perhaps not (a layout word in a class), not.
KEPT, DOUBTED, DROPPED = 0, 1, 2
CLOSES = {tag: frozenset(t for t, by in CLOSED_BY.items() if tag in by) for tag in frozenset().union(*CLOSED_BY.values())}
_LANDMARKS = ("html", "body", "main", "article")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=100_000)
def _child(parent: int, style: str) -> tuple[int, int]:
    """Hashes of the node below ``parent`` with this style, and of the style."""
    return _hash(f"{parent}/{style}"), _hash(style)


class Element:
    """An open element: its node in the tree, known by the hash of its path, and what it is to the article."""

    __slots__ = ("article", "node", "parent", "plain", "style", "tag", "verdict")

    def __init__(self, tag: str, style: str, classed: bool, above: Element | None, verdict: int):
        self.tag, self.verdict = tag, verdict
        self.parent = above.node if above else 0
        self.node, self.style = _child(self.parent, style)
        opens = tag in ("article", "main")
        self.article = opens or bool(above and above.article)
        #: Inside an article under no class but its own: never removed for repeating.
        self.plain = opens or bool(above and above.plain and not classed)


def _verdict(tag: str, found: dict[str, str], above: Element) -> int:
    if above.verdict == DROPPED or tag in BOILERPLATE_TAGS or found.get("role", "").lower() in BOILERPLATE_ROLES:
        return DROPPED
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return DROPPED
    named = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    if tag in _LANDMARKS:  # their classes tell about the page; an article may be a comment
        return DROPPED if tag == "article" and not REPLY_WORDS.isdisjoint(named) else KEPT if tag in ("article", "main") else above.verdict
    words = [_WORDS.findall(name) for name in named]
    if above.article:
        only = any(w and BOILERPLATE_WORDS.issuperset(w) for w in words)
        return DROPPED if only else above.verdict
    if any(not REPLY_WORDS.isdisjoint(w) for w in words):
        return DROPPED
    # such a word may also tell how the page is laid out around an article
    return DOUBTED if any(not BOILERPLATE_WORDS.isdisjoint(w) for w in words) else above.verdict


def blocks(html: str | None) -> Iterator[tuple[Element, str]]:
    """(innermost element, text) of each block of a page, in page order.

    A block ends where a block element starts or ends. Blocks whose element's verdict is not KEPT never hold article
    text. Broken markup (missing ends, stray ends, a page cut off) is read as far as it goes. The work for a tag does
    not depend on how deep it stands.
    """
    stack = [Element("", "", False, None, KEPT)]
    open_tags: Counter[str] = Counter()
    deciders: list[int] = []  # places in the stack of elements that a start tag may close or must stop at
    text: list[str] = []

    def flush() -> Iterator[tuple[Element, str]]:
        whole = _SPACE.sub(" ", "".join(text)).strip()
        text.clear()
        if whole:
            yield stack[-1], whole

    def close(place: int) -> None:
        for element in stack[place:]:
            open_tags[element.tag] -= 1
        del stack[place:]
        while deciders and deciders[-1] >= place:
            deciders.pop()

    for kind, tag, found in tokens(html or "", RAW_TAGS):
        if kind == TEXT:
            text.append(unescape(found))
        elif kind == END:
            if open_tags[tag] <= 0:
                continue
            place = len(stack) - 1
            while stack[place].tag != tag:
                place -= 1
            if tag in BLOCK_TAGS or any(e.tag in BLOCK_TAGS or e.verdict for e in stack[place:]):
                yield from flush()
            close(place)
        elif kind == START:
            if tag in BLOCK_TAGS or tag in BOILERPLATE_TAGS:
                yield from flush()
            if tag in RAW_TAGS or tag in VOID or found.endswith("/"):
                continue
            # an element whose end may be left out ends where the next of its kind starts
            while tag in CLOSES and deciders:
                top = stack[deciders[-1]].tag
                if top in CLOSES[tag]:
                    close(deciders[-1])
                    break
                if top != "p":
                    break
                deciders.pop()
            known = attributes(found) if found else {}
            names = ".".join(known.get("class", "").split())
            verdict = _verdict(tag, known, stack[-1])
            if verdict != stack[-1].verdict:
                yield from flush()
            if tag in CLOSED_BY or tag in BLOCK_TAGS:
                deciders.append(len(stack))
            stack.append(Element(tag, f"{tag}.{names}" if names else tag, bool(names or known.get("id")), stack[-1], verdict))
            open_tags[tag] += 1
    yield from flush()


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of hashes for each node of a page that may belong to the article; page is the hash of all these blocks."""
    names = [f.split()[0] for f in _NODES.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.bool_()]
    for batch in batches:
        rows: list[tuple] = []
        for host, row, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            said: dict[tuple, list[str]] = {}
            order = []
            for element, text in blocks(html):
                if element.verdict == KEPT:
                    place = (element.node, element.parent, element.style, element.plain)
                    said.setdefault(place, []).append(text)
                    order.append(f"{element.node} {text}")
            page = _hash("\n".join(order))  # a block's text holds no line feed
            rows += [(host, row, page, *place[:3], _hash("\n".join(texts)), place[3]) for place, texts in said.items()]
            if len(rows) > 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page with the nodes and texts of its blocks, in page order; batches end at about 4 million characters."""
    parts = pa.list_(pa.struct([("node", pa.int64()), ("text", pa.string())]))
    for batch in batches:
        first, size, found = 0, 0, []
        for i, html in enumerate(batch.column(3).to_pylist()):
            shown = [{"node": e.node, "text": text} for e, text in blocks(html) if e.verdict == KEPT]
            found.append(shown)
            size += len(html or "")
            if size > 1 << 22 or i + 1 == batch.num_rows:
                columns = [batch.column(c).slice(first, len(found)) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, parts)], ["page_id", "url", "row", "parts"])
                first, size, found = i + 1, 0, []


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _entropy(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Entropy of the counts of each key, as a share of the largest possible; 1 where there is one occurrence."""
    n, s = F.sum("n").alias("n"), F.sum(F.col("n") * F.log2("n")).alias("s")
    return counts.groupBy(*keys).agg(n, s).select(
        *keys, F.col("n").alias("seen"),
        F.when(F.col("n") > 1, (F.log2("n") - F.col("s") / F.col("n")) / F.log2("n")).otherwise(1.0).alias("entropy"),
    )


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, node, importance, pages) for the nodes that may go and that enough different pages of their host hold.

    Importance is the entropy of the node's content over the pages, with a share of the entropy of the styles that
    stand beside it under its parent. Nodes are known by the hash of their path.
    """
    nodes = nodes.drop("row").distinct()  # equal pages of a host are one
    texts = nodes.where("not plain").groupBy("host", "parent", "node", "content").agg(F.count("*").alias("n"))
    content = _entropy(texts, ["host", "parent", "node"])
    styles = nodes.groupBy("host", "parent", "style").agg(F.count("*").alias("n"))
    shape = _entropy(styles, ["host", "parent"]).select("host", "parent", F.col("entropy").alias("shape"))
    joined = content.where(F.col("seen") >= MIN_PAGES).join(shape, ["host", "parent"])
    importance = (1 - SHAPE) * F.col("entropy") + SHAPE * F.col("shape")
    return joined.select("host", "node", importance.alias("importance"), F.col("seen").alias("pages"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html).

    Null and empty html gives an empty text. Rows that repeat are separate pages. Other columns are ignored. Blocks
    are joined in page order by a line feed; nothing is cut off.

    Pages are read twice: once for the hashes that the tree counts, once for the texts. So texts move at most once,
    to meet the nodes that their page loses, and are never written in between.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("row", F.xxhash64("page_id", "url", "html"))
    sites = rows.select(host_of(F.col("url")).alias("host"), "row", "html").where("host <> ''")
    nodes = stored(sites.mapInArrow(_nodes, _NODES), "nodes")
    low = style_tree(nodes).where(F.col("importance") < LOW_IMPORTANCE).select("host", "node")
    lost = nodes.where("not plain").join(low, ["host", "node"], "left_semi")
    lost = lost.groupBy("row").agg(F.collect_set("node").alias("lost"))  # at most the nodes of one page
    texts = rows.select("page_id", "url", "row", "html").mapInArrow(_texts, _TEXTS).join(lost, "row", "left")
    kept = F.filter("parts", lambda p: ~F.coalesce(F.array_contains("lost", p["node"]), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda p: p["text"]), "\n").alias("text")
    return texts.select("page_id", "url", text).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

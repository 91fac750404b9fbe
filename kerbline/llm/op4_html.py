"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node that is either main content or not. A potential joins each child to its
parent: how likely a child with such a name is content, given the parent. A second one joins a node to
what is seen of it: tag, number of words, share of words in links. Both are learned from labelled pages,
and Spark counts them. Messages go up the tree and down again (sum-product), which gives each node's
marginal probability given the whole page. Nodes over one half are content.

Labelled pages are those that mark their article (`article`, `main` or role main); a node is content there
if it is inside and in no part that by its tag or names is a menu, header, footer, sidebar, notice,
advert, form or comment section. A name tells that only as a whole (`comments`, `site-footer`): one that has
other parts (`related-work`, `no-sidebar`) leaves the node to the messages. Such names also count on pages that
mark nothing, but not for html and body, and not where they would leave a page nearly without text: there a box, or boxes of one name, that
hold most of the words outside links are judged by the messages alone, and so are their parts. At most
TRAINING_PAGES labelled pages are used, picked by a digest; extraction covers all pages.

Scripts, styles, templates and comments in the markup hold no text. Character references are decoded,
white space inside a block becomes one space, blocks are joined in page order by two line ends. Null and
empty pages have an empty text. Tags need not be closed or balanced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = "op4_html"
#: Labelled pages that the potentials are learned from, about.
TRAINING_PAGES = 20_000
#: A child without telling names is content with at least and at most this chance, whatever its parent.
EVEN = 1e-3
#: Count that every value of a feature has before training.
SMOOTHING = 1.0
#: Elements open at once, as in browsers; what is nested deeper becomes a sibling.
DEEPEST = 512

# Tags by what they mean for the text.
SILENT = {"template", "svg", "object", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "img", "br", "wbr",
}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"}
INSIDE = {"article", "main"}
# Parts of class names, ids and roles.
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "commentlist", "contentinfo", "complementary", "consent", "cookie", "cookies", "copyright", "dialog",
    "disqus", "footer", "form", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "reply", "respond", "search",
    "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
# Parts that say nothing beside others, as in `site-footer` or `comment-list`.
NEUTRAL_NAMES = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "global", "group", "inner", "item",
    "items", "left", "link", "links", "list", "main", "mobile", "page", "panel", "primary", "right", "secondary",
    "section", "site", "top", "wrap", "wrapper",
}
INSIDE_NAMES = {"article", "articlebody", "entry", "main", "post", "story"}

#: Tags whose start ends an open element of the second set.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

TAGS = ("p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "main", "nav",
        "header", "footer", "aside", "form", "table", "tr", "td", "blockquote", "pre", "body", "html")
NONE, OUT, IN = 0, 1, 2
_PARTS = re.compile(r"[a-z]+")

#: A tag with its name and attributes. It ends before the next `<`, so a search is linear in the page.
_TAG = re.compile(
    r"<(?:(!--)|[!?][^<>]*>|(/?)([a-zA-Z][^\s/<>]*)([^<>\"']*(?:(?:\"[^\"<]*\"|'[^'<]*')[^<>\"']*)*)>)"
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}


#: Pages that mark their article, as Spark SQL.
MARKED = r"""lower(html) RLIKE '<(article|main)[\\s/>]|role\\s*=\\s*[\"\']?main'"""


class Node:
    __slots__ = ("cause", "children", "hint", "linked", "parent", "tag", "words")

    def __init__(self, tag: str, hint: int, parent: int, cause: str = ""):
        self.tag, self.hint, self.parent, self.cause = tag, hint, parent, cause
        self.words = self.linked = 0
        self.children: list[int] = []


def _hint(tag: str, attributes: str) -> tuple[int, str]:
    """What a tag and its names say: outside the text, inside it, or nothing; and which of them say outside."""
    if tag in OUTSIDE:
        return OUT, tag
    outside: set[str] = set()
    inside = tag in INSIDE
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id", "role", "itemprop", "aria-label"):
            for name in value.lower().split():
                parts = set(_PARTS.findall(name))
                told = parts & OUTSIDE_NAMES
                # `related-work` and `no-sidebar` are about something else: no part may be left over.
                if told and parts <= OUTSIDE_NAMES | NEUTRAL_NAMES:
                    outside |= told
                inside = inside or bool(parts & INSIDE_NAMES)
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return OUT, "hidden"
        elif key == "style" and value and "display:none" in value.replace(" ", "").lower():
            return OUT, "hidden"
    if outside:
        return OUT, " ".join(sorted(outside))
    return (IN if inside else NONE), ""


class Page:
    """Block elements of a page as nodes in page order, and its blocks of text with their nodes."""

    def __init__(self, html: str):
        self.nodes = [Node("html", NONE, -1)]
        self.blocks: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = [("html", 0)]
        self.silent = self.links = 0
        self.parts: list[str] = []
        self._read(html)
        self._end_block()
        self._settle()

    def _settle(self) -> None:
        """Take back hints that would leave the page nearly without text, hand the others down to parts."""
        nodes = self.nodes
        plain = [node.words - node.linked for node in nodes]
        held = plain.copy()
        for i in range(len(nodes) - 1, 0, -1):
            held[nodes[i].parent] += held[i]
        for node in nodes:
            if node.tag in ("html", "body") and node.hint == OUT:
                node.hint = NONE
        while True:
            outside = [False] * len(nodes)
            groups: dict[str, list[int]] = {}
            for i, node in enumerate(nodes):
                above = i > 0 and outside[node.parent]
                outside[i] = node.hint == OUT or node.hint == NONE and above
                if node.hint == OUT and not above:
                    groups.setdefault(node.cause, []).append(i)
            free = sum(n for n, out in zip(plain, outside, strict=True) if not out)
            if 10 * free >= held[0]:
                break
            boxes = [[i] for group in groups.values() for i in group] + list(groups.values())
            wide = next((box for box in boxes if 2 * sum(held[i] for i in box) > held[0]), None)
            if wide is None:
                break
            for i in wide:
                nodes[i].hint = NONE
        for node, out in zip(nodes, outside, strict=True):
            if out:
                node.hint = OUT

    def _read(self, html: str) -> None:
        at = 0
        while (m := _TAG.search(html, at)) is not None:
            self._text(html[at : m.start()])
            at = m.end()
            if m[1]:  # a comment; without an end it takes the rest
                end = html.find("-->", at)
                if end < 0:
                    return
                at = end + 3
            elif m[3]:
                tag = m[3].lower()
                if m[2]:
                    self._end(tag)
                elif tag in RAW:
                    end = re.compile(f"</{tag}[^<>]*>", re.IGNORECASE).search(html, at)
                    if end is None:
                        return
                    at = end.end()
                else:
                    self._start(tag, m[4])
        self._text(html[at:])

    def _end_block(self) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            self.parts = []
            if words:
                self.blocks.append((self.open[-1][1], " ".join(words)))

    def _pop(self, at: int) -> None:
        """Close the open elements from `at` on."""
        if any(tag not in INLINE for tag, _ in self.open[at:]):
            self._end_block()
        for tag, _ in self.open[at:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[at:]

    def _last(self, tags: set[str], stop: set[str] = frozenset()) -> int:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in tags:
                return at
            if self.open[at][0] in stop:
                break
        return 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag not in INLINE:
                self._end_block()
            return
        if tag in INLINE:
            if len(self.open) >= DEEPEST:
                return
            self.links += tag == "a"
            self.open.append((tag, self.open[-1][1]))
            return
        self._end_block()
        at = self._last({"p"}, {"table", "td", "li", "div", "article", "section", "button"})
        if at:
            self._pop(at)
        if tag in CLOSES:
            at = self._last(CLOSES[tag], {"ul", "ol", "dl", "table"})
            if at:
                self._pop(at)
        if tag == "html":
            return
        if len(self.open) >= DEEPEST:
            self._pop(DEEPEST - 1)
        parent = self.open[-1][1]
        hint, cause = _hint(tag, attributes)
        self.nodes.append(Node(tag, hint, parent, cause))
        self.nodes[parent].children.append(len(self.nodes) - 1)
        self.open.append((tag, len(self.nodes) - 1))
        self.silent += tag in SILENT

    def _end(self, tag: str) -> None:
        at = self._last({tag})
        if at:
            self._pop(at)
        elif tag == "p":
            self._end_block()

    def _text(self, data: str) -> None:
        if self.silent or not data:
            return
        data = unescape(data)
        self.parts.append(data)
        n = len(data.split())
        node = self.nodes[self.open[-1][1]]
        node.words += n
        if self.links:
            node.linked += n


def features(node: Node) -> tuple[int, int, int]:
    """What is seen of a node: tag, size in words, share of linked words."""
    tag = TAGS.index(node.tag) if node.tag in TAGS else len(TAGS)
    size = 0 if not node.words else min(5, 1 + int(np.log2(node.words) / 1.5))
    share = 0 if not node.linked else 1 + min(2, 3 * node.linked // (node.words + 1))
    return tag, size, share


SIZES = (len(TAGS) + 1, 6, 4)


def labels(page: Page) -> list[int] | None:
    """1 for content nodes of a page that marks its article, else None."""
    if not any(node.hint == IN and node.tag in INSIDE for node in page.nodes):
        return None
    out = []
    for node in page.nodes:
        above = out[node.parent] if node.parent >= 0 else 0
        out.append(0 if node.hint == OUT else 1 if node.hint == IN else above)
    return out


class Potentials:
    """Tables learned from counts: child[parent label, hint, label] and seen[feature][value, label]."""

    def __init__(self, counts: dict[tuple[int, int, int, int], int]):
        child = np.full((2, 3, 2), SMOOTHING)
        # What the names mean is known before training.
        child[:, OUT, 0] += 1e7
        child[:, IN, 1] += 1e7
        child[0, NONE, 0] += 10
        child[1, NONE, 1] += 10
        seen = [np.full((n, 2), SMOOTHING) for n in SIZES]
        for (kind, a, b, label), n in counts.items():
            if kind == 0:
                child[a, b, label] += n
            else:
                seen[kind - 1][a, label] += n
        child /= child.sum(axis=2, keepdims=True)
        child[:, NONE] = np.clip(child[:, NONE], EVEN, 1 - EVEN)
        self.child = child.tolist()
        self.seen = [(t / t.sum(axis=0)).tolist() for t in seen]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content, by messages up and then down the tree."""
        n = len(nodes)
        own, up = [], [(1.0, 1.0)] * n
        for node in nodes:
            a = b = 1.0
            for table, value in zip(self.seen, features(node), strict=True):
                a *= table[value][0]
                b *= table[value][1]
            own.append([a, b])
        # Children come after their parents, so reversed order goes up.
        for i in range(n - 1, 0, -1):
            a, b = own[i]
            scale = a + b
            own[i] = a, b = a / scale, b / scale
            table = self.child
            k = nodes[i].hint
            up[i] = (table[0][k][0] * a + table[0][k][1] * b, table[1][k][0] * a + table[1][k][1] * b)
            above = own[nodes[i].parent]
            above[0] *= up[i][0]
            above[1] *= up[i][1]
            if above[0] + above[1] < 1e-200:
                above[0] *= 1e150
                above[1] *= 1e150
        out = [0.0] * n
        # The root of the tree is no content before its children are seen.
        belief = [(own[0][0] * (1 - EVEN), own[0][1] * EVEN)] + [(0.0, 0.0)] * (n - 1)
        for i, node in enumerate(nodes):
            if i:
                above = belief[node.parent]
                without = (above[0] / up[i][0], above[1] / up[i][1])
                k, table = node.hint, self.child
                down = [without[0] * table[0][k][y] + without[1] * table[1][k][y] for y in (0, 1)]
                belief[i] = (own[i][0] * down[0], own[i][1] * down[1])
            scale = belief[i][0] + belief[i][1]
            belief[i] = (belief[i][0] / scale, belief[i][1] / scale)
            out[i] = belief[i][1]
        return out


def main_text(html: str | None, potentials: Potentials) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = Page(html)
    chance = potentials.marginals(page.nodes)
    return "\n\n".join(text for node, text in page.blocks if chance[node] > 0.5)


def train(pages: DataFrame, most: int = TRAINING_PAGES) -> Potentials:
    """Potentials from about `most` labelled pages of `pages` (html), or all if there are fewer."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for html in batch["html"].to_pylist():
                page = Page(html)
                label = labels(page)
                if label is None:
                    continue
                for i, node in enumerate(page.nodes):
                    if i:
                        held[0, label[node.parent], node.hint, label[i]] += 1
                    for k, value in enumerate(features(node)):
                        held[k + 1, value, 0, label[i]] += 1
        rows = [(*key, n) for key, n in held.items()]
        columns = zip(*rows, strict=True) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["kind", "a", "b", "label", "n"]
        )

    marked = pages.filter(F.expr(MARKED)).select("html")
    n = max(marked.count(), 1)
    share = F.xxhash64("html") % 1_000_000
    picked = marked.filter(F.abs(share) < F.lit(int(1e6 * min(1.0, most / n)))) if n > most else marked
    found = (
        picked.mapInArrow(count, "kind long, a long, b long, label long, n long")
        .groupBy("kind", "a", "b", "label")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most 2 rows for every value of a feature
    )
    return Potentials({(r.kind, r.a, r.b, r.label): r.n for r in found})


def extracted(html: Column, potentials: Potentials) -> Column:
    """The main text of a column of pages."""

    def over(column: pa.Array) -> pa.Array:
        return pa.array((main_text(h, potentials) for h in column.to_pylist()), pa.string())

    return F.arrow_udf(over, "string")(html)


def extract(pages: DataFrame, potentials: Potentials, html: str = "html") -> DataFrame:
    """Add text and n_chars; existing columns of these names are replaced."""
    out = pages.withColumn("text", extracted(F.col(f"`{html}`"), potentials))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return extract(pages, train(pages)).select("page_id", "url", "text", "n_chars")

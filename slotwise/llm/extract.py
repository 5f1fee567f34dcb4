"""Main text of HTML pages by composite text density.

For every node of the document tree the characters per tag are counted and adjusted for links: a
node whose characters or tags are mostly links is thin. The node whose children have the greatest
sum of densities is the core of the article. The least density on the way from it up to the body
is the threshold: what stands beside that way is taken too if it is as dense.

Elements for menus, page headers, scripts and the like are left out of the tree. Names are hints: if
there are `article` or `main` elements, the core is looked for in them, and what stands in the one
that holds it belongs to it unless it is thin, below the threshold and nearly all links. Elements
whose class, id or role tells of notices, adverts, forms or comments are left out unless they
hold the only article, or nearly all text of a page without one.

Trees are built as browsers do for the common cases: void elements, implied ends of paragraphs,
items and cells, raw text of scripts, stray and missing end tags. The time taken grows with the
length of a page, whatever its depth: the nearest open element of a name is looked up, and no part
of a page is read again.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import batches, rest_of

#: Elements without an end tag, and those whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template noembed noframes xmp".split())
#: Elements that stand for a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
CELLS = frozenset(("td", "th", "br", "option"))
#: Elements that are no part of an article.
LEFT_OUT = frozenset(
    "nav footer aside script style noscript template iframe object embed svg canvas head select button input textarea "
    "dialog menu audio video map".split()
)
#: Parts of class names and ids that say the same of any element.
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent "
    "gdpr notice notices alert alerts notification sidebar sidebars aside menu menus nav navbar navigation topnav breadcrumb breadcrumbs "
    "comment comments commentlist respond reply replies disqus discussion share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search footer header masthead popup modal overlay widget widgets toolbar pagination "
    "pager skip copyright legal disclaimer feedback tags tagcloud".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P = ({"p"}, {"td", "th", "li", "div", "article", "section", "body", "blockquote"})
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_TO_VALUE = re.compile(r"[^>=]*(?:=\s*|>|\Z)")
_PLAIN = re.compile(r"[^\s>]*")
#: Elements that may be a list of links, what share counts as nearly all, and the least text of a
#: page (in characters) for which hints against other parts count.
LINK_BLOCKS, NEARLY, LEAST = frozenset("ul ol dl menu div section table p span".split()), 0.9, 140
_MARKED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def _left_out(tag: str, attributes: str, inside_article: bool) -> bool:
    return tag in LEFT_OUT or (tag == "header" and not inside_article) or (tag != "body" and bool(_HIDDEN.search(attributes)))


def _marked(tag: str, attributes: str, inside_article: bool) -> bool:
    """Does a name tell that the element is no part of the article?"""
    if tag == "form":
        return True
    if not attributes or tag in ("html", "body", "main", "h1"):
        return False
    for name, value in _MARKED.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in ROLES:
                return True
        else:
            found = set(_PART.findall(value))
            if found & MARKS and not (inside_article and found <= {"article", "post", "entry", "header", "title"}):
                return True
    return False


class Tree:
    """Nodes in document order, each after its parent, and pieces of text (node, text), where a
    text of None is the edge of a block."""

    def __init__(self, page: str) -> None:
        self.tag, self.parent, self.skip, self.mark = ["#"], [-1], [False], [False]
        self.pieces: list[tuple[int, str | None]] = []
        self._open: list[int] = [0]
        self._where: dict[str, list[int]] = {}  # depths of the open elements of a name
        self._quotes = {q: page.rfind(q) for q in "\"'"}
        at = 0
        while at < len(page):
            found = _TOKEN.search(page, at)
            text = page[at : found.start() if found else len(page)]
            if text and not self.skip[self._open[-1]]:
                self.pieces.append((self._open[-1], entities.unescape(text)))
            if not found:
                break
            at = found.end()
            if not found[2]:
                continue
            tag, end = found[2].lower(), self._tag_end(page, at)
            attributes, at = page[at : end - 1 if page[end - 1 : end] == ">" else end], end
            if found[1]:
                if self._where.get(tag):
                    self._close(self._where[tag][-1])
                continue
            closed, until = _ENDS.get(tag, _ENDS_P if tag in BLOCKS else ((), ()))
            depth = max((self._where[n][-1] for n in closed if self._where.get(n)), default=0)
            if depth and depth > max((self._where[n][-1] for n in until if self._where.get(n)), default=0):
                self._close(depth)
            up, inside = self._open[-1], bool(self._where.get("article"))
            node = len(self.tag)
            self.tag.append(tag)
            self.parent.append(up)
            self.skip.append(self.skip[up] or _left_out(tag, attributes, inside))
            self.mark.append(_marked(tag, attributes, inside))
            self._edge(node, up)
            if tag in RAW:
                stop = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
                at = stop.start() if stop else len(page)
            if tag not in VOID and not attributes.endswith("/"):
                self._where.setdefault(tag, []).append(len(self._open))
                self._open.append(node)

    def _tag_end(self, page: str, at: int) -> int:
        """Behind the > of a tag; quotes count where a value begins with one that is closed."""
        while at < len(page):
            at = _TO_VALUE.match(page, at).end()
            if page[at - 1] == ">":
                return at
            quote = page[at : at + 1]
            if quote in self._quotes and at < self._quotes[quote]:
                at = page.index(quote, at + 1) + 1
            else:
                at = _PLAIN.match(page, at).end()
        return len(page)

    def _close(self, depth: int) -> None:
        while len(self._open) > depth:
            node = self._open.pop()
            self._where[self.tag[node]].pop()
            self._edge(node, self._open[-1])

    def _edge(self, node: int, up: int) -> None:
        if self.tag[node] in BLOCKS:
            self.pieces.append((up, None))
        elif self.tag[node] in CELLS:
            self.pieces.append((up, " "))

    def measure(self, skip: list[bool]) -> Measure:
        """Counts and densities of every node, without those to be skipped."""
        count = len(self.tag)
        chars, links, tags, link_tags = [0] * count, [0] * count, [0] * count, [0] * count
        linked = [False] * count
        for n in range(1, count):
            linked[n] = self.tag[n] == "a" or linked[self.parent[n]]
        for n, text in self.pieces:
            if text:
                size = len("".join(text.split()))
                chars[n] += size
                links[n] += size * linked[n]
        for n in range(count - 1, 0, -1):
            up = self.parent[n]
            if not skip[n]:
                chars[up] += chars[n]
                links[up] += links[n]
                tags[up] += tags[n] + 1
                link_tags[up] += link_tags[n] + (self.tag[n] == "a")
        share = links[0] / max(1, chars[0])
        density, sums = [0.0] * count, [0.0] * count
        for n in range(count - 1, -1, -1):
            if chars[n] and not skip[n]:
                density[n] = composite(chars[n], links[n], tags[n], link_tags[n], share)
                if n:
                    sums[self.parent[n]] += density[n]
        return Measure(chars, links, link_tags, density, sums)

    def _below(self, own: list[bool]) -> list[bool]:
        """Which nodes have the mark or stand below one that has it."""
        out = list(own)
        for n in range(1, len(out)):
            out[n] = out[n] or out[self.parent[n]]
        return out

    def _way(self, node: int) -> list[int]:
        """The nodes from one up to the body, without that."""
        way = []
        while node > 0 and self.tag[node] not in ("body", "html"):
            way.append(node)
            node = self.parent[node]
        return way

    def _without(self, mark: list[bool], node: int) -> list[bool]:
        """Marks without those of a node and what it stands in."""
        for n in self._way(node):
            mark[n] = False
        return mark

    def content(self) -> list[bool]:
        """Which nodes belong to the article."""
        count, mark = len(self.tag), list(self.mark)
        kinds = ("article", "main")
        named = next((f for name in kinds if (f := [n for n in range(count) if self.tag[n] == name and not self.skip[n]])), [])
        hidden = self._below(mark)
        if named and all(hidden[n] for n in named):  # hints do not count against the only article
            whole = self.measure(self.skip)
            mark = self._without(mark, max(named, key=lambda n: (whole.chars[n], -n)))
        skip = [a or b for a, b in zip(self.skip, self._below(mark), strict=True)]
        seen = self.measure(skip)
        named = [n for n in named if not skip[n] and seen.density[n]]
        if not named and seen.chars[0] < LEAST and any(mark):  # nor against nearly all text
            whole = self.measure(self.skip)
            if whole.chars[0] > 2 * seen.chars[0]:
                most = max(whole.chars[n] for n in range(count) if mark[n])
                inner = max(n for n in range(count) if mark[n] and whole.chars[n] >= NEARLY * most)  # of wrappers
                mark = self._without(mark, inner)
                skip = [a or b for a, b in zip(self.skip, self._below(mark), strict=True)]
                seen = self.measure(skip)
        in_scope = [False] * count
        for n in named:
            in_scope[n] = True
        scope = self._below(in_scope) if named else [True] * count
        inside = [n for n in range(count) if seen.density[n] and scope[n]]
        if not inside:
            return [False] * count
        core = self._core(seen, inside)
        way = self._way(core)
        threshold = min((seen.density[n] for n in way if seen.density[n]), default=0.0)
        top = next((n for n in reversed(way) if in_scope[n]), core)
        body = self.parent[way[-1]] if way else core
        on_way = {*way, body, 0}
        out = [False] * count
        for n in range(count):
            up = self.parent[n]
            beside = up in on_way and n not in on_way and seen.density[n] >= threshold > 0 and scope[n]
            out[n] = (n in (core, top) or (up >= 0 and out[up]) or beside) and not skip[n] and not self._list_of_links(seen, n, threshold)
        return out

    def _core(self, seen: Measure, nodes) -> int:
        """The node of the greatest sum of its children's densities."""
        core = max(nodes, key=lambda n: (seen.sums[n] or seen.density[n] * 0.5, -n))
        return core if seen.sums[core] else max(self.parent[core], 0)

    def _list_of_links(self, seen: Measure, n: int, threshold: float) -> bool:
        """Is a node thin, with nothing but links?"""
        several = seen.link_tags[n] > 1 and seen.links[n] >= NEARLY * seen.chars[n]
        return several and self.tag[n] in LINK_BLOCKS and seen.density[n] < threshold


class Measure(NamedTuple):
    """Of each node: characters, those in links, links, density, sum of the children's densities."""

    chars: list[int]
    links: list[int]
    link_tags: list[int]
    density: list[float]
    sums: list[float]


def composite(chars: int, links: int, tags: int, link_tags: int, share: float) -> float:
    """Characters per tag, adjusted for the share of characters and tags that are links; `share` is
    that of the whole page."""
    lc, t, lt = max(1, links), max(1, tags), max(1, link_tags)
    base = math.log(chars / max(1, chars - links) * links + share * chars + math.e)
    return chars / t * (math.log(max(1.0, chars / lc * t / lt)) + 1e-3) / math.log(base + math.e)


def main_text(page: str) -> str:
    """The blocks of the article, each with single blanks, joined by line feeds."""
    tree = Tree(page)
    keep = tree.content()
    blocks, block = [], []
    for node, text in [*tree.pieces, (0, None)]:
        if text is None:
            done = " ".join("".join(block).split())
            if done:
                blocks.append(done)
            block = []
        elif keep[node]:
            block.append(text)
    return "\n".join(blocks)


def extracted(pages: DataFrame) -> DataFrame:
    """All columns of `pages` in a struct `row`, with `main_text`. Null, empty and textless pages
    give an empty text; repeated rows each get theirs."""
    batches(pages.sparkSession, 500)
    rows = pages.select(rest_of(pages, "html").alias("row"), "html")

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            texts = [main_text(h.as_py() or "") for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "main_text"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, main_text string").select(
        "row", F.col("main_text")
    )

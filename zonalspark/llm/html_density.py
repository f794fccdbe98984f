"""Operator 1: main text of HTML pages by composite text density.

Each element gets its characters per tag, adjusted by how much of it is link
text; the densities of its children add up to its density sum. The subtree with
the largest sum is the content. The smallest density on the path from there to
the body is the threshold: what stands beside that path and is at least as
dense also counts, if it is text of its own (a heading, a paragraph, a list).
Elements that by their tag, role or class are menus, headers, footers,
sidebars, notices, adverts, forms or reader comments are cut beforehand; not so
forms, headers and elements with a name such as "widget" that hold most of the text.

A content subtree inside an article or main element stands for all of it. Of
subtrees with one density sum the first in the page wins; elements that are as
dense as the threshold count.

Null, empty and text-less pages give the empty string. Unclosed tags, comments
and quotes end where the page ends. A page of any length and depth is parsed whole,
in time linear in it. Repeated rows each get a row; an empty table gives none.
Extra columns of ``extract_pages`` stay, but for one named as its result.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: An attribute as the tokenizer of HTML reads it: a quote counts only right after the equals sign, anywhere else it is a letter.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)"""
_ATTRIBUTE = rf"""=?[^\s/>=]++(?:\s*+=\s*+{_VALUE}?+)?+"""
_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE}|=)*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(rf"""(=?[^\s/>=]++)(?:\s*+=\s*+({_VALUE})?+)?+""")
_NAMED = frozenset("class id role hidden aria-hidden style".split())

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: What shows nothing and parts no words.
SILENT = frozenset("script style template noscript link meta".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist", "optgroup"})}

CUT_TAGS = frozenset("nav header footer aside form button select datalist input menu dialog svg canvas object audio video map head fieldset".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar note status toolbar".split())
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar sidebars rail nav navbar navigation menu menus breadcrumb breadcrumbs "
    "header headers masthead topbar footer footers bottombar comment comments commentlist reply replies respond responses disqus discussion notice notices cookie cookies consent gdpr alert alerts "
    "warning modal popup popover overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget widgets toolbar "
    "pagination pager copyright disclaimer legal popular trending feedback skip form forms search".split()
)
#: Names that also stand at the content itself: an element that has no other one is spared if it holds most of the text.
WEAK_NAMES = frozenset(
    "promo promotion sponsor sponsored header headers banner notice notices alert alerts warning modal overlay login signup share sharing social related recommended recommendations "
    "widget widgets copyright disclaimer legal popular trending feedback skip form forms search".split()
)
#: Cut unless they hold an article, main or most of the text that is in no other cut.
WRAPPERS = frozenset("form header fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre ul ol dl table figure section article main".split())


#: Elements that decide where an open list item, cell or option ends.
_LISTED = frozenset(x for tag, (same, scope) in SIBLINGS.items() for x in (tag, *same, *scope))


class Node:
    """An element. near and block: the closest of it and its ancestors that is listed, or no plain inline element."""

    __slots__ = ("tag", "parent", "children", "cut", "chars", "tags", "link_chars", "link_tags", "density", "total", "first", "last", "named", "in_link", "holds", "near", "block")

    def __init__(self, tag: str, parent: Node | None, first: int):
        self.tag, self.parent, self.children, self.cut, self.first, self.last, self.named = tag, parent, [], False, first, first, 0
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.in_link, self.holds = tag == "a" or (parent is not None and parent.in_link), False
        self.near = self if tag in _LISTED or parent is None else parent.near
        self.block = parent.block if tag in INLINE and parent is not None else self


def _named_cut(attributes: str, heading: bool = False) -> int:
    """2 if what the attributes say cuts the element, 1 if only unless it holds most of the text, else 0."""
    out = 0
    for name, value in _NAMES.findall(attributes):
        name = name.lower()
        if name not in _NAMED:
            continue
        value = entities.unescape(value.strip("\"'")).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return 2
        if name == "role" and CUT_ROLES.intersection(value.split()):
            return 2
        if not heading and name in ("class", "id") and (found := CUT_NAMES.intersection(re.split(r"[\s_\-:.]+|(?<=[a-z])\d+", value))):
            out = max(out, 1 if found <= WEAK_NAMES else 2)
    return out


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree, and the texts in page order with the element that holds each; a None text ends a block.

    Every step goes to an element that it closes, or to one that it knows: the time is linear in the page.
    """
    root = Node("#root", None, 0)
    pieces: list[tuple[Node, str | None]] = []
    node, at = root, 0
    opened: Counter[str] = Counter()  # elements that are open, by tag
    order: list[Node] = []

    def text(upto: int) -> None:
        if at < upto:
            pieces.append((node, page[at:upto]))

    def close(to: Node) -> None:
        nonlocal node
        while True:
            node.last = len(pieces)
            if node.tag not in INLINE:
                pieces.append((node, None))
                node.last = len(pieces)
            opened[node.tag] -= 1
            done, node = node is to, node.parent
            if done:
                return

    match = _TAG.search(page)
    while match:
        start, end = match.span()
        text(start)
        at = end
        tag = match[2]
        if tag:
            tag, closing, attributes = tag.lower(), bool(match[1]), match[3]
            if closing:
                if opened[tag]:
                    up = node
                    while up.tag != tag:
                        up = up.parent
                    close(up)
                elif tag in ("p", "br"):
                    pieces.append((node, None))
            else:
                if tag in CLOSES_P:
                    if node.block.tag == "p":
                        close(node.block)
                elif tag in SIBLINGS:
                    same, scope = SIBLINGS[tag]
                    up = node.near
                    while up is not root and up.tag not in scope and any(opened[x] for x in same):
                        if up.tag in same:
                            close(up)
                            up = node.near
                        else:
                            up = up.parent.near
                if tag not in INLINE and tag not in SILENT:
                    pieces.append((node, None))
                child = Node(tag, node, len(pieces))
                node.children.append(child)
                order.append(child)
                child.cut = tag in CUT_TAGS
                if attributes and tag not in ("html", "body", "article", "main"):
                    child.named = _named_cut(attributes, tag in HEADINGS)
                if tag in RAW:
                    child.cut = True
                    stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                    at = stop.end() if stop else len(page)
                elif tag not in VOID:  # HTML ignores a closing slash of elements that have content
                    node = child
                    opened[tag] += 1
        elif match[0].startswith("<![CDATA["):
            pieces.append((node, entities.escape(match[0][9:].removesuffix("]]>"))))
        match = _TAG.search(page, at)
    text(len(page))
    close_all = node
    while close_all is not None:
        close_all.last = len(pieces)
        close_all = close_all.parent
    for child in reversed(order):  # children after their parents
        if child.holds or child.tag in ("article", "main", "h1"):
            child.parent.holds = True
    return root, pieces


def _spare(root: Node, pieces: list[tuple[Node, str | None]]) -> None:
    """Takes back the cuts of wrappers, and those by weak names, of elements that hold the content."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if (node.cut and node.tag not in WRAPPERS) or (node.named == 2 and not node.holds):
            continue
        order.append(node)
        stack += node.children
    if not any(x.cut or x.named for x in order):
        return
    chars, whole = dict.fromkeys(map(id, order), 0), set()
    for node, text in pieces:
        if text and id(node) in chars:
            chars[id(node)] += len("".join(text.split()))
    for node in reversed(order):
        if node is not root:
            chars[id(node.parent)] += chars[id(node)]
            if node.tag in ("article", "main") or id(node) in whole:
                whole.add(id(node.parent))
    for node in order:
        most = 2 * chars[id(node)] > chars[id(root)]
        if node.cut and (id(node) in whole or most):
            node.cut = False
        if most and id(root) not in whole:  # an article elsewhere is the content
            node.named = 0


def _measure(root: Node, pieces: list[tuple[Node, str | None]]) -> list[Node]:
    """Fills counts, densities and sums; returns the elements outside of cuts, parents first."""
    _spare(root, pieces)
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.cut = node.cut or (node.named and not node.holds)
        if node.cut:
            continue
        order.append(node)
        stack += reversed(node.children)
    live = set(map(id, order))
    for node, text in pieces:
        if text and id(node) in live:
            n = len("".join(text.split()))
            node.chars += n
            if node.in_link:
                node.link_chars += n
    for node in reversed(order):
        for child in node.children:
            if not child.cut:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.tags += child.tags + 1
                node.link_tags += child.link_tags + (child.tag == "a")
    body = next((x for x in order if x.tag == "body"), root)
    ratio = body.link_chars / max(body.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if c:
            base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
            adjusted = math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0))
            node.density = c / t * (adjusted / math.log(base) if base > 1.001 else adjusted)
    for node in order:
        node.total = sum(child.density for child in node.children if not child.cut)
    return order


def extract(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root, pieces = parse(page)
    order = _measure(root, pieces)
    if not root.chars:
        return ""
    body = next((x for x in order if x.tag == "body"), root)
    best = max(order, key=lambda x: x.total)
    if not best.total:
        best = max(order[::-1], key=lambda x: x.density)
    up = best
    while up is not None:  # inside an article: all of the article
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    path, threshold, up = {id(best)}, best.density, best
    while up is not body and up.parent is not None:
        up = up.parent
        path.add(id(up))
        threshold = min(threshold, up.density)
    keep = bytearray(len(pieces))

    content = [best]
    up = best
    while up.parent is not None and up is not body:
        up = up.parent
        content += [c for c in up.children if not c.cut and id(c) not in path and c.density >= threshold and c.density > 0 and c.tag in BESIDE]
    for node in content:
        keep[node.first : node.last] = b"\x01" * (node.last - node.first)
        stack = list(node.children)
        while stack:
            x = stack.pop()
            if x.cut:
                keep[x.first : x.last] = bytes(x.last - x.first)
            else:
                stack += x.children
    text = "".join((" " if t is None else entities.unescape(t)) for (_, t), k in zip(pieces, keep, strict=True) if k or t is None)
    return " ".join(text.split())


def extract_pages(pages: DataFrame, *, html: str = "html", out: str = "text") -> DataFrame:
    """pages without the html, with its main text."""
    keep = [c for c in pages.columns if c not in (html, out)]
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([extract(x) for x in batch.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], names=[*keep, out])

    return pages.select(*keep, html).mapInArrow(run, schema)


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    return extract_pages(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))

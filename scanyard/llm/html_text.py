"""Main text of web pages by composite text density.

A page becomes a tree. Every block element has a density: its characters per tag, adjusted by how
much of it is links, here and in the body. An element's sum is that of its children's densities,
and the subtree of the largest sum holds the main text. The least density on the way from it up to
the body is the threshold: where a sibling of the subtree, or of an element above it, is as dense,
or is a heading, the common parent takes its place. What that gives inside an ``article`` or ``main``
element grows to that element; where siblings of the element are as dense, it holds them too. Elements that are boilerplate by their tag, role or class (menus,
headers, footers, sidebars, notices, adverts, forms, comments) are taken out beforehand. A class
or a form only hints at that: an element of more than ``LITTLE`` characters that has the larger part
of the page's text outside links stays, unless it is of comments and more than ``LITTLE`` are in
an ``article`` or ``main``; and where hints would leave no text, they are not followed.

Blocks are text between the bounds of block elements. Their character references are decoded,
their white space becomes one space, and blocks are joined by an empty line.

Defined cases: null and empty pages, and pages without text, give an empty text; text without any
tags is one block; what follows an unclosed comment, script or tag is lost as in a browser; the
tree has no recursion, so any depth of nesting works; repeated rows each get a row; columns other
than id, URL and page are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard.llm.common import findable, slices

# Fixed values of the markup language: elements without content, with raw content, inside a line.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
# Elements a start tag of the key closes, up to the nearest element of the scope.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split())
DROPPED = frozenset(
    "head script style noscript template svg math iframe object button select textarea "
    "input nav footer aside dialog menu title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert "
                  "alertdialog dialog".split())
_HINTS = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|side-?bar\w*|"
    r"footer|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|share|sharing|"
    r"social|related|recommend\w*|comments?|disqus|repl(?:y|ies)|breadcrumbs?|pagination|pager|"
    r"toolbar|masthead|copyright)")
# One class: a hint is the first or the last part of its name, or the class is a widget's own.
HINT = re.compile(rf"{_HINTS}(?:[-_].*)?|.*[-_]{_HINTS}|widgets?(?:[-_]area)?", re.S)
# Parts of names that say how a page is laid out around or without such an element.
LAYOUT = re.compile(r"(?:^|[-_])(?:has|with|without|no|not|layout|wrap|wrapper)(?:$|[-_])")
COMMENTS = re.compile(r"(?:^|[-_])(?:comments?|disqus|repl(?:y|ies))(?:$|[-_])")
LITTLE = 100
HEADINGS = frozenset(("h1", "h2"))

# A quote opens a value only right after "=" and white space; elsewhere it is like any character.
_NAME, _VALUE = r"[^\s/>][^\s/>=]*+", r"\s*+=\s*+(?:\"{}(?:\"|$)|'{}(?:'|$)|{}|(?=>|$))"
_REST = rf"(?:[\s/]++|{_NAME}(?:{_VALUE.format(r'[^\"]*+', r"[^']*+", r"[^\s>\"'][^\s>]*+")})?+)*+"
_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|$)|(?P<other>[!?])[^>]*(?:>|$)|"
    r"/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|$)|"
    rf"(?P<start>[a-zA-Z][^\s/>]*)(?P<rest>{_REST})(?P<shut>>?))", re.S)
_ATTRIBUTE = re.compile(
    rf"({_NAME})(?:{_VALUE.format(r'([^\"]*+)', r"([^']*+)", r"([^\s>\"'][^\s>]*+)")})?+")


class Tree:
    """Elements in page order: a parent's number is below its children's."""

    def __init__(self, page: str):
        self.tag, self.parent, self.drop = ["#root"], [-1], [False]
        self.hints: list[list[str]] = [[]]  # the names that hint at boilerplate
        # What a page holds, in order: (element, text), or (element, None) where a block is bound.
        self.flow: list[tuple[int, str | None]] = []
        # Open elements, outermost first; the places there of each tag and of those that are blocks.
        self.open: list[int] = [0]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        at = 0
        while at < len(page):
            found = _TAG.search(page, at)
            if not found:
                self._text(self.open[-1], page[at:])
                break
            if found.start() > at:
                self._text(self.open[-1], page[at:found.start()])
            at = found.end()
            if found["end"]:
                self._close(found["end"].lower())
            elif found["start"]:
                if not found["shut"]:
                    break
                at = self._start(found["start"].lower(), found["rest"], page, at)
        self._bound(0)

    def _text(self, element: int, text: str) -> None:
        self.flow.append((element, text))

    def _bound(self, element: int) -> None:
        self.flow.append((element, None))

    def _start(self, tag, rest, page, at) -> int:
        if tag in ENDS_P:
            self._shut({"p"}, {"table", "td", "th", "button"})
        if tag in CLOSES:
            self._shut(*CLOSES[tag])
        me, parent = len(self.tag), self.open[-1]
        self.tag.append(tag)
        self.parent.append(parent)
        drop, hints = self._boilerplate(tag, rest)
        self.drop.append(drop)
        self.hints.append(hints)
        if tag not in INLINE:
            self._bound(me)
        elif tag == "br":
            self._text(me, " ")
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            if tag == "textarea" or tag == "title":
                self._text(me, page[at:end.start() if end else len(page)])
            self._bound(me)
            return end.end() if end else len(page)
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            if tag not in INLINE:
                self.blocks.append(len(self.open))
            self.open.append(me)
        return at

    def _nearest(self, tags) -> int:
        """The innermost place of an open element of some tags, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _shut(self, tags, scope) -> None:
        """Close the nearest open element of some tags, looking no further than a scope."""
        place = self._nearest(tags)
        if place and place >= self._nearest(scope):
            self._pop(place)

    def _close(self, tag) -> None:
        place = self._nearest((tag,))
        # An end tag within a line does not reach beyond the block it stands in.
        if place and not (tag in INLINE and self.blocks and self.blocks[-1] > place):
            self._pop(place)

    def _pop(self, place) -> None:
        """Close an element and all inside it: each is looked at once, when it ends."""
        if self.blocks and self.blocks[-1] >= place:
            self._bound(self.open[place])
        for element in reversed(self.open[place:]):
            self.places[self.tag[element]].pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()
        del self.open[place:]

    @staticmethod
    def _boilerplate(tag: str, rest: str) -> tuple[bool, list[str]]:
        """Whether an element is boilerplate for certain, and what hints at it."""
        if tag in DROPPED:
            return True, []
        hints = ["form"] if tag == "form" else []
        if not rest.strip(" /\n") or tag in ("html", "body", "article", "main"):
            return False, hints
        names = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(rest)}
        if "hidden" in names or names.get("aria-hidden", "").lower() == "true":
            return True, []
        if names.get("role", "").lower() in ROLES:
            return True, []
        given = f"{names.get('class', '')} {names.get('id', '')}".lower().split()
        return False, hints + [n for n in given if HINT.fullmatch(n) and not LAYOUT.search(n)]


def _sizes(tree: Tree, gone: list[bool]) -> tuple[list[int], ...]:
    """Characters, tags, link characters and link tags inside each element."""
    count = len(tree.tag)
    link = [False] * count
    for e in range(1, count):
        link[e] = tree.tag[e] == "a" or link[tree.parent[e]]
    chars, tags, links, anchors = ([0] * count for _ in range(4))
    for e, text in tree.flow:
        if text and not gone[e]:
            size = len("".join(text.split()))
            chars[e] += size
            links[e] += size * link[e]
    for e in range(count - 1, 0, -1):
        if not gone[e]:
            up = tree.parent[e]
            chars[up] += chars[e]
            links[up] += links[e]
            tags[up] += tags[e] + 1
            anchors[up] += anchors[e] + (tree.tag[e] == "a")
    return chars, tags, links, anchors


def density(chars, tags, links, anchors, body_links, body_chars) -> float:
    """Characters per tag; a logarithm lowers it for what is mostly links."""
    if not chars:
        return 0.0
    tags, linked, anchors = max(tags, 1), max(links, 1), max(anchors, 1)
    base = math.log(chars / max(chars - links, 1) * linked
                    + body_links / max(body_chars, 1) * chars + math.e)
    return chars / tags * max(math.log(chars / linked * tags / anchors), 0.0) / math.log(base)


def main_element(tree: Tree, gone: list[bool]) -> int:
    """The element that holds the main text."""
    count = len(tree.tag)
    chars, tags, links, anchors = _sizes(tree, gone)
    block = [tree.tag[e] not in INLINE and not gone[e] for e in range(count)]
    dense = [density(chars[e], tags[e], links[e], anchors[e], links[0], chars[0])
             if block[e] else 0.0 for e in range(count)]
    sums = [0.0] * count
    children: list[list[int]] = [[] for _ in range(count)]
    for e in range(1, count):
        if block[e]:
            up = tree.parent[e]
            while not block[up] and up:
                up = tree.parent[up]
            children[up].append(e)
            sums[up] += dense[e]
    best = max(range(count), key=lambda e: (sums[e], -e))
    path = [best]
    while path[-1]:
        path.append(tree.parent[path[-1]])
    top = [e for e in path if block[e] and tree.tag[e] not in ("html", "#root")] or [best]
    least = min(dense[e] for e in top)
    for below, above in zip(path, path[1:]):
        if any(e != below and (dense[e] >= least > 0 or tree.tag[e] in HEADINGS and chars[e])
               for e in children[above]):
            best = above
    named = [e for e in path[path.index(best):] if tree.tag[e] in ("article", "main")]
    return named[0] if named else best


def _gone(tree: Tree) -> list[bool]:
    """Elements taken out as boilerplate."""
    count = len(tree.tag)
    named = [tag in ("article", "main") for tag in tree.tag]
    holds = list(named)
    for e in range(count - 1, 0, -1):
        holds[tree.parent[e]] |= holds[e]

    def taken(chosen: list[bool]) -> list[bool]:
        gone, inside = [False] * count, [False] * count
        for e in range(1, count):
            up = tree.parent[e]
            inside[e] = inside[up] or named[e]
            # What wraps the article is not boilerplate; a header inside it has its title.
            header = tree.tag[e] == "header" and not inside[e]
            gone[e] = gone[up] or (chosen[e] or header) and not holds[e]
        return gone

    sure = taken(tree.drop)
    if not any(tree.hints):
        return sure
    chars, _, links, _ = _sizes(tree, sure)
    own = [c - n for c, n in zip(chars, links)]
    article = max((own[e] for e in range(count) if named[e]), default=0)

    def stays(e: int) -> bool:
        comments = article > LITTLE and any(map(COMMENTS.search, tree.hints[e]))
        return 2 * own[e] > own[0] and own[e] > LITTLE and not comments

    gone = taken([tree.drop[e] or bool(tree.hints[e]) and not stays(e) for e in range(count)])
    if own[0] and not any(text and text.strip() and not gone[e] for e, text in tree.flow):
        return sure
    return gone


def main_text(page: str) -> str:
    tree = Tree(page)
    count = len(tree.tag)
    gone = _gone(tree)
    root = main_element(tree, gone)
    within = [False] * count
    within[root] = True
    for e in range(root + 1, count):
        within[e] = within[tree.parent[e]]
    blocks, parts = [], []
    for e, text in tree.flow:
        if text is None:
            blocks.append("".join(parts))
            parts = []
        elif within[e] and not gone[e]:
            parts.append(html.unescape(text))
    blocks.append("".join(parts))
    return "\n\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text."""
    findable(pages.sparkSession)
    given = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    kinds = {f.name: f.dataType.simpleString() for f in given.schema}

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = [main_text(b.decode("utf-8", "replace"))
                         for b in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string())],
                    ["id", "url", "text"])

    return given.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string")

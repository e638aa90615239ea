"""Main text of web pages by scores in the element tree."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without end tag, elements whose content is no markup, elements that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search"
    " section select summary table tbody td tfoot th thead tr ul".split()
)
# A start tag of the first kind ends an open element of the second, if no element of the third lies between.
ENDS_BEFORE = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEEPS_P = frozenset("button td th caption table object".split())

# What is no main text as a rule: by element, by role, by a part of a class name or id. The rule does not hold for what
# the best container lies in.
OTHER_TAGS = frozenset(
    "nav footer aside form button select dialog menu head input fieldset search option datalist label".split()
)
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
OTHER_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice"
    " notices notification pagination popup promo promoted promotion related reply replies responses share sharing"
    " sidebar sidebars signup social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
ROOT_TAGS = frozenset("html body article main".split())

# Names of what stands over an article or over a page: the first is part of the text.
HEADER_NAMES = frozenset("header masthead".split())

DISCOUNT = 0.05  # of the points of a block, for each element around it that is no main text as a rule
LEVELS = 5  # elements above a block that get points

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_GAP = re.compile(r"[\s/]*+")
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*+")
_EQUALS = re.compile(r"\s*+=\s*+")
_BARE = re.compile(r"[^\s>]*+")
_RAW_END = {tag: re.compile(f"</{tag}\\s*+>", re.I) for tag in RAW}
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(source: str, at: int) -> tuple[dict[str, str], int] | None:
    """Attributes of a tag from behind its name on, and where it ends; None if it does not.

    Every character is looked at a few times at most, whatever the page holds.
    """
    found: dict[str, str] = {}
    size = len(source)
    while True:
        at = _GAP.match(source, at).end()
        if at >= size:
            return None
        if source[at] == ">":
            return found, at + 1
        name = _ATTRIBUTE.match(source, at)
        at, value = name.end(), ""
        equals = _EQUALS.match(source, at)
        if equals:
            at = equals.end()
            if source[at:at + 1] in ("'", '"'):
                stop = source.find(source[at], at + 1)
                if stop < 0:
                    return None
                value, at = source[at + 1:stop], stop + 1
            else:
                bare = _BARE.match(source, at)
                value, at = bare[0], bare.end()
        found.setdefault(name[0].lower(), html.unescape(value))


def _other(tag: str, attributes: dict[str, str]) -> str:
    """What is to be said against an element: nothing (empty), that it may stand over an article, or all else."""
    if tag in ROOT_TAGS:
        return ""
    if tag in OTHER_TAGS:
        return "other"
    if tag == "header":
        return "header"
    if not attributes:
        return ""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return "other"
    if attributes.get("role", "").lower() in OTHER_ROLES:
        return "other"
    names = attributes.get("class", "") + " " + attributes.get("id", "")
    against = {part.lower() for part in _NAME_PART.findall(names)} & OTHER_NAMES
    return "" if not against else "header" if against <= HEADER_NAMES else "other"


class Element:
    __slots__ = ("tag", "parent", "body", "other", "chars", "linked", "points")

    def __init__(self, tag: str, parent: Element | None, body: bool = False, other: str = ""):
        self.tag, self.parent, self.body, self.other = tag, parent, body, other
        self.chars = self.linked = self.points = 0.0

    @property
    def link_density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0

    @property
    def score(self) -> float:
        return self.points * (1.0 - self.link_density)


class Tree:
    """Blocks of text of a page in page order, each with the element it stands in; scores are on the elements."""

    def __init__(self, source: str):
        self.top = Element("", None)
        self.elements: list[Element] = []  # a parent stands before its children
        self.blocks: list[tuple[Element, str]] = []
        self.open = [self.top]
        self.places: dict[str, list[int]] = {}  # of the open elements, by tag
        self.block_places = [0]
        self.links = 0
        self.others = [0]  # for each open element, how many around a block in it are no main text as a rule
        self.parts: list[str] = []
        self.linked: list[str] = []
        self._read(source)
        self._flush()
        for e in reversed(self.elements):  # what an element holds, its parents hold
            e.parent.chars += e.chars
            e.parent.linked += e.linked

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            start = source.find("<", at)
            if start < 0:
                self._text(source[at:])
                return
            if start > at:
                self._text(source[at:start])
            at = self._markup(source, start)

    def _markup(self, source: str, start: int) -> int:
        """Read what begins with ``<``; gives the place behind it."""
        size = len(source)
        for begin, end in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
            if source.startswith(begin, start):
                stop = source.find(end, start + len(begin))
                return size if stop < 0 else stop + len(end)
        ends = source.startswith("</", start)
        name = _NAME.match(source, start + 1 + ends)
        if not name:
            self._text("<")
            return start + 1
        found = _attributes(source, name.end())
        if found is None:  # no tag ends any more: the rest is text
            self._text(source[start:])
            return size
        tag, (attributes, at) = name[0].lower(), found
        if ends:
            self._end(tag)
        elif tag in RAW:
            if not (source[at - 2] == "/" and tag in ("svg", "math")):
                close = _RAW_END[tag].search(source, at)
                return close.end() if close else size
        else:
            self._start(tag, attributes)
        return at

    def _text(self, text: str) -> None:
        # What is no main text inside a block, such as a label, holds no container and goes at once.
        if self.others[-1] > self.others[self.block_places[-1]]:
            return
        self.parts.append(text)
        if self.links:
            self.linked.append(text)

    def _flush(self) -> None:
        """End the block that is being read; its points go to what holds it."""
        if not self.parts:
            return
        text = " ".join(html.unescape("".join(self.parts)).split())
        linked = len(" ".join(html.unescape("".join(self.linked)).split())) if self.linked else 0
        self.parts, self.linked = [], []
        if not text:
            return
        holder = self.open[self.block_places[-1]]
        self.blocks.append((holder, text))
        weight = DISCOUNT ** min(self.others[self.block_places[-1]], 4)
        holder.chars += weight * len(text)
        holder.linked += weight * linked
        points = (1.0 + text.count(",") + text.count("，") + text.count("、") + len(text) / 100) * (1 - linked / max(linked, len(text)))
        above = holder if holder.tag in ("div", "section", "article", "main", "td", "body", "") else holder.parent or holder
        for level in range(LEVELS):
            above.points += weight * points / (1, 2, 6, 9, 12)[level]
            above = above.parent
            if above is None:
                break

    def _push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.open))
        if element.tag in BLOCKS:
            self.block_places.append(len(self.open))
        self.open.append(element)
        self.elements.append(element)
        # An article puts aside what there is to be said against what it stands in.
        self.others.append(0 if element.body else self.others[-1] + bool(element.other))
        self.links += element.tag == "a"

    def _last(self, tags: frozenset[str] | set[str]) -> tuple[int, str]:
        """Place and tag of the innermost open element of some tags; 0 if none is open."""
        return max(((self.places[t][-1], t) for t in tags if self.places.get(t)), default=(0, ""))

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "hr":
                self._flush()
            return
        if tag in BLOCKS:
            self._flush()
            place, ended = self._last(KEEPS_P | {"p"})
            if ended == "p":
                self._pop(place)
        if tag in ENDS_BEFORE:
            ends, bound = ENDS_BEFORE[tag]
            place, ended = self._last(ends | bound)
            if ended in ends:
                self._pop(place)
        body = tag in ("article", "main") or attributes.get("role") == "main" or "articleBody" in attributes.get("itemprop", "")
        self._push(Element(tag, self.open[-1], body, _other(tag, attributes)))

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        place, _ = self._last({tag})
        # An inline end tag does not reach out of its block.
        if not place or (tag not in BLOCKS and self.block_places[-1] > place):
            return
        self._pop(place)

    def _pop(self, to: int) -> None:
        if self.block_places[-1] >= to:
            self._flush()
        while len(self.open) > to:
            e = self.open.pop()
            self.places[e.tag].pop()
            if e.tag in BLOCKS:
                self.block_places.pop()
            self.others.pop()
            self.links -= e.tag == "a"


def _above(e: Element | None) -> set[int]:
    out = set()
    while e is not None:
        out.add(id(e))
        e = e.parent
    return out


def _parts(tree: Tree) -> dict[int, bool]:
    """For each element, by identity, whether it belongs to the main text.

    The container is the element with the best score or, if that lies in an article or main element, the outermost of
    these. It and the siblings that go with it belong, but for what stands in them and is no main text as a rule.
    """
    holders = [e for e in tree.elements if e.points > 0]
    if not holders:
        return {id(tree.top): True} | {id(e): not e.other for e in tree.elements}
    best = max(holders, key=lambda e: e.score)
    root, up = best, best
    while up is not None:
        if up.body:
            root = up
        up = up.parent
    spared = _above(best)
    belongs = {id(tree.top): root is tree.top}
    for e in tree.elements:
        inside = belongs[id(e.parent)]
        dropped = e.other and id(e) not in spared and not (e.other == "header" and inside)
        if dropped:
            belongs[id(e)] = False
        elif e is root:
            belongs[id(e)] = True
        elif inside or e.parent is not root.parent or not e.chars:
            belongs[id(e)] = inside
        else:
            belongs[id(e)] = bool(e.score >= 0.2 * best.score > 0 or e.tag == "h1" or (not root.body and e.link_density < 0.25))
    return belongs


def main_text(source: str | None) -> str:
    """Blocks of the main text, joined by two line feeds; empty for null, empty and textless pages.

    Each block of text gives points for its length and its commas to the elements above it, less the higher they
    stand, discounted by the share of its text in links. Menus, page headers, footers, sidebars, notices, adverts,
    forms, hidden parts and reader comments are known by element, role, class and id; a block in one of them counts a
    twentieth, unless an article or main element in them holds it. The element with the best score is the container; if it lies in an article or main element, that is.
    Siblings are kept that score a fifth as much, and, where no article is marked, those with few links. Of what is
    left the parts known as above go, but none that the best element lies in, and no header of the container. Scripts,
    styles and other content that is no markup never count. The time is in proportion to the length of the page.
    """
    if not source:
        return ""
    tree = Tree(source)
    belongs = _parts(tree)
    return "\n\n".join(text for holder, text in tree.blocks if belongs[id(holder)])


def page_text(source: Column) -> Column:
    """``main_text`` of a column."""

    @F.arrow_udf("string")
    def text(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return text(source.cast("string"))


def with_main_text(pages: DataFrame, source: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page under ``name``, which takes the place of a column of that name.

    Rows are independent and nothing is shuffled; rows that repeat are read each. A null or empty page has an empty
    text, an empty table stays empty, and other columns stay as they are.
    """
    return pages.withColumn(name, page_text(F.col(source)))

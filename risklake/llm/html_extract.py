"""Main text of web pages by tree scoring.

A page is read into a tree of elements; what end tags leave out is closed as browsers do.
Menus, forms, scripts, notices, adverts and reader comments are dropped by tag, role or name.
Every paragraph gives points for its length and commas to the elements around it, fewer the
farther up; an element's points are discounted by the share of its text in links. The element
with the most is kept, with those of its siblings that have enough points too. One page is one
row's work and no page needs another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML, and names by which sites mark what is not their article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed xmp".split())
DROPPED = frozenset(
    "script style textarea title noscript template iframe noembed xmp head nav footer aside form button select "
    "svg canvas object audio video dialog menu datalist map math".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of the second kind ends an open element of the first, up to a border.
CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}),
    "thead": frozenset({"tr", "td", "th", "thead", "tbody"}), "tbody": frozenset({"tr", "td", "th", "thead", "tbody"}),
}
PARAGRAPHS = frozenset({"p", "h1", "h2", "h3", "h4", "h5", "h6"})
BORDERS = frozenset("table ul ol dl div section article main aside nav header footer body html td th form blockquote".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored sponsors promo promos promotion nav navbar navigation menu "
    "menus menubar breadcrumb breadcrumbs pagination pager sidebar sidebars aside widget widgets footer masthead header topbar toolbar cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments disqus respond replies reply feedback copyright legal disclaimer toc skip search hidden".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
KEPT_NAMES = frozenset("article content main post entry body story text page".split())
#: Of these, words that an article also uses: inside of one they drop a part only if it is mostly links as well.
EVERYDAY_NAMES = frozenset("social legal search feedback copyright reply respond".split())
LINKED_SHARE = 0.3
#: Points that an element has by its tag alone.
TAG_POINTS = {"article": 25.0, "main": 25.0, "section": 3.0, "div": 3.0, "blockquote": 1.0, "pre": 1.0, "td": 1.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0}
#: Shares of a paragraph's points for the elements above it, nearest first.
SHARES = (1.0, 0.5, 1 / 3, 0.25, 0.2)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>", re.DOTALL
)
#: One attribute: its name and its value, quoted or bare. Quoted text without a name is passed over.
_ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class _Element:
    __slots__ = ("tag", "parent", "dropped", "suspect", "in_article", "points", "size", "link_size", "kept")

    def __init__(self, tag: str, parent: _Element | None, dropped: bool, suspect: bool = False):
        self.tag, self.parent, self.dropped, self.suspect = tag, parent, dropped, suspect
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        self.points = TAG_POINTS.get(tag, 0.0)
        self.size = self.link_size = 0
        self.kept = False


class _Stack:
    """Open elements. The last border and what is open above it are found without a search."""

    def __init__(self, root: _Element):
        self.open = [root]
        #: Places of elements that aren't inline; the last one owns a text.
        self.blocks = [0]
        #: Per border: its place, and by tag the places of what is open above it. Borders are in their own scope.
        self.scopes: list[tuple[int, dict[str, list[int]]]] = [(0, {})]
        self.count: dict[str, int] = {}

    def push(self, element: _Element) -> None:
        tag, place = element.tag, len(self.open)
        self.open.append(element)
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag not in INLINE:
            self.blocks.append(place)
        if tag in BORDERS:
            self.scopes.append((place, {}))
        else:
            self.scopes[-1][1].setdefault(tag, []).append(place)

    def cut(self, place: int) -> list[_Element]:
        gone = self.open[place:]
        while len(self.open) > place:
            tag = self.open.pop().tag
            self.count[tag] -= 1
            if tag in BORDERS:
                self.scopes.pop()
            else:
                self.scopes[-1][1][tag].pop()
        while self.blocks[-1] >= place:
            self.blocks.pop()
        return gone

    def ended_by_end_tag(self, tag: str) -> int:
        """The place of the element that an end tag closes, 0 if none. An inline one reaches to the last border."""
        if tag in INLINE:
            return (self.scopes[-1][1].get(tag) or [0])[-1]
        if not self.count.get(tag):
            return 0
        return next(i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag)

    def ended_by_start_tag(self, tag: str) -> int:
        """The outermost element that a start tag closes, up to a border that it doesn't close; 0 if none."""
        ended = CLOSES.get(tag, frozenset()) | PARAGRAPHS
        place = 0
        for border, held in reversed(self.scopes):
            mine = [held[t][0] for t in ended if held.get(t)]
            place = min([place, *mine]) if place and mine else min(mine, default=place)
            if not border or self.open[border].tag not in ended:
                break
            place = border
        return place


def _is_dropped(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element goes, and whether it goes if it is mostly links."""
    if tag in DROPPED or (tag == "header" and not inside_article):
        return True, False
    if not attributes or tag in ("html", "body", "main"):
        return False, False
    names: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        value, name = next((v for v in values if v), ""), name.lower()
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True, False
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name in ("class", "id"):
            # A part called hidden hides nothing (overflow-hidden), only the class of that name does.
            names.update({x.lower() for x in _NAME.findall(value)} - {"hidden"})
        if name == "class" and "hidden" in value.lower().split():
            names.add("hidden")
    if names & {"comment", "comments", "disqus", "replies"}:
        return True, False
    if tag == "article" or names & KEPT_NAMES:
        return False, False
    found = names & DROPPED_NAMES
    if inside_article and found and found <= EVERYDAY_NAMES:
        return False, True
    return bool(found), False


def blocks_of(html: str) -> tuple[list[tuple[str, int, _Element]], list[_Element]]:
    """The page's text blocks (text, characters in links, element), dropped ones left out, and its elements in
    order of their start."""
    root = _Element("", None, False)
    stack, out, elements = _Stack(root), [], [root]
    parts: list[str] = []
    linked = [0, 0]  # open links, characters in them

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text and not stack.open[-1].dropped:
            out.append((text, min(linked[1], len(text)), stack.open[stack.blocks[-1]]))
        parts.clear()
        linked[1] = 0

    def add(text: str) -> None:
        if text and not stack.open[-1].dropped:
            text = unescape(text)
            parts.append(text)
            if linked[0]:
                linked[1] += len(" ".join(text.split()))

    def close_to(place: int) -> None:
        if stack.blocks[-1] >= place:
            flush()
        linked[0] -= sum(e.tag == "a" for e in stack.cut(place))

    at, end, last = 0, len(html), html.rfind(">")
    while at < end:
        mark = html.find("<", at)
        if mark < 0 or mark > last:
            # No tag is finished from here on; an unclosed comment hides the rest.
            comment = html.find("<!--", at)
            add(html[at:] if comment < 0 else html[at:comment])
            break
        add(html[at:mark])
        found = _TAG.match(html, mark)
        if not found:
            add("<")
            at = mark + 1
            continue
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            place = stack.ended_by_end_tag(tag)
            if place:
                close_to(place)
            elif tag in ("p", "br"):
                flush()
            continue
        if tag == "br" or tag == "hr":
            flush()
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            place = stack.ended_by_start_tag(tag)
            if place:
                close_to(place)
            else:
                flush()
        parent = stack.open[-1]
        dropped, suspect = (True, False) if parent.dropped else _is_dropped(tag, found[3] or "", parent.in_article)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*[^>]*>", re.IGNORECASE).search(html, at)
            at = stop.end() if stop else end
            continue
        if (found[3] or "").rstrip().endswith("/") and tag not in INLINE:
            continue
        element = _Element(tag, parent, dropped, suspect)
        elements.append(element)
        stack.push(element)
        linked[0] += tag == "a"
    flush()
    return out, elements


def _paragraph_points(text: str) -> float:
    return 1.0 + text.count(",") + text.count("，") + min(len(text) / 100, 3.0)


def _sizes(found: list[tuple[str, int, _Element]], order: list[_Element]) -> None:
    """Characters and linked characters of every element with all that is in it, added up from the inside."""
    for element in order:
        element.size = element.link_size = 0
    for text, linked, owner in found:
        owner.size += len(text)
        owner.link_size += linked
    for element in reversed(order[1:]):
        element.parent.size += element.size
        element.parent.link_size += element.link_size


def main_text(html: str | None) -> str:
    """The blocks of the best element and its kept siblings, in page order, one a line. Linear in the page."""
    found, order = blocks_of(html or "")
    _sizes(found, order)
    if any(e.suspect for e in order):
        for element in order[1:]:
            mostly_links = element.suspect and element.link_size > LINKED_SHARE * element.size
            element.dropped = element.dropped or element.parent.dropped or mostly_links
        found = [f for f in found if not f[2].dropped]
        _sizes(found, order)
    if not found:
        return ""
    elements: dict[int, _Element] = {}
    for text, linked, owner in found:
        points = _paragraph_points(text) * (1 - linked / len(text))
        inner = owner.tag in ("p", "pre", "li", "td", "th", "dt", "dd", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6")
        element, level = (owner.parent if inner and owner.parent else owner), 0
        while element is not None and level < len(SHARES):
            element.points += points * SHARES[level]
            elements[id(element)] = element
            element, level = element.parent, level + 1
    rated = lambda e: e.points * (1 - e.link_size / e.size if e.size else 1)
    best = max(elements.values(), key=rated)
    # An article holds all of its sections, also those with few points.
    outer = best
    while outer is not None and outer.tag not in ("article", "main"):
        outer = outer.parent
    best = outer or best
    enough = max(10.0, 0.2 * rated(best))
    best.kept = True
    for element in elements.values():
        if element is not best and element.parent is best.parent and best.parent is not None and rated(element) >= enough:
            element.kept = True
    for element in order[1:]:
        element.kept = element.kept or element.parent.kept

    def beside(text: str, linked: int, owner: _Element) -> bool:
        # A paragraph beside the best element belongs to it if it reads like one.
        near = owner.tag in ("p", "pre", "blockquote") and owner.parent is best.parent and best.parent is not None
        share = linked / len(text)
        return near and ((len(text) > 80 and share < 0.25) or (share == 0 and bool(re.search(r"[.!?。](\s|$)", text))))

    return "\n".join(f[0] for f in found if f[2].kept or beside(*f))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` but ``html_col``, with text and n_chars.

    A null or empty page has an empty text, and so has one without text outside of what is
    dropped. Markup is read as far as it goes: unclosed elements end with the page, an unclosed
    comment hides what follows, an unfinished tag is text. Columns called text and n_chars are replaced.
    """
    source = pages.drop(*(c for c in ("text", "n_chars") if c != html_col))
    kept = [c for c in source.columns if c != html_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(html) for html in part.column(html_col).to_pylist()]
                yield pa.record_batch({c: part.column(c) for c in kept} | {
                    "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                })

    schema = [f"`{n}` {t}" for n, t in source.dtypes if n != html_col]
    return source.withColumn(html_col, F.col(html_col).cast("string")).mapInArrow(run, ", ".join([*schema, "text string", "n_chars long"]))

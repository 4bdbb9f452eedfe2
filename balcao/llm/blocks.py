"""Leaf blocks of a web page: runs of text between block-level tags, with the path of open elements above them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

# Elements that stay inside a line of text, elements without content, elements whose content is never text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg title select object".split())
#: Without an end tag these take the rest of the page, as browsers read it; of the others only the start tag goes.
TO_THE_END = frozenset(("script", "style"))
# Elements that a start tag closes, if open since the last element that bounds it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

#: A block names so many of its outermost and innermost elements; deeper nesting is for the labels alone without meaning.
PATH_ENDS = 40
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
_STOP = re.compile(r"=\s*[\"']|>")
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


class Tag(NamedTuple):
    """A start or end tag; ``name`` is empty for comments and declarations, which say nothing."""

    name: str
    end: bool
    rest: str


class Scanner:
    """Text and tags of a page in one pass: every search starts where the last one ended, and a search that has failed once is not
    made again, so broken markup costs no more than any other."""

    def __init__(self, page: str):
        self.page = page
        self.last_close, self.last_comment = page.rfind(">"), page.rfind("-->")
        self.quotes = True
        self.without_end: set[str] = set()

    def __iter__(self) -> Iterator[str | Tag]:
        page, at, n = self.page, 0, len(self.page)
        while at < n:
            lt = page.find("<", at)
            if lt < 0:
                yield page[at:]
                return
            if lt > at:
                yield page[at:lt]
            if lt > self.last_close:
                # No tag or comment ends from here on: comments go, the rest is text.
                if page.startswith("<!--", lt):
                    return
                yield page[lt:]
                return
            mark = page[lt + 1]
            if mark in "!?":
                comment = page.startswith("<!--", lt) and self.last_comment >= lt + 2
                at = page.find("-->", lt + 2) + 3 if comment else page.find(">", lt) + 1
                yield Tag("", False, "")
            elif m := _TAG.match(page, lt):
                close = self._close(m.end())
                name, rest = m[2].lower(), page[m.end() : close]
                at = close + 1
                if name in RAW and not m[1] and not rest.endswith("/"):
                    at = self._after_raw(name, at)
                yield Tag(name, bool(m[1]), rest)
            else:
                yield "<"
                at = lt + 1

    def _close(self, at: int) -> int:
        """The ``>`` that ends a tag: not one inside a quoted value, unless the quotes of the page do not pair."""
        start = at
        while self.quotes and at <= self.last_close and (m := _STOP.search(self.page, at)):
            if m[0] == ">":
                return m.start()
            at = self.page.find(m[0][-1], m.end()) + 1
            if not at:
                break
        self.quotes = False
        return self.page.find(">", start)

    def _after_raw(self, name: str, at: int) -> int:
        """Where the page goes on after an element whose content is never text."""
        m = None if name in self.without_end else _end_of(name).search(self.page, at)
        if m:
            close = self.page.find(">", m.end())
            return close + 1 if close >= 0 else len(self.page)
        self.without_end.add(name)
        return len(self.page) if name in TO_THE_END else at


@lru_cache(maxsize=64)
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])", re.I)


class Kind(NamedTuple):
    """A tag with the words of its class, id and role."""

    tag: str
    names: tuple[str, ...] = ()


class Element:
    """An open element: one for each start tag, so two of a kind are told apart."""

    __slots__ = ("kind",)

    def __init__(self, kind: Kind):
        self.kind = kind

    @property
    def tag(self) -> str:
        return self.kind.tag


class Block(NamedTuple):
    text: str
    path: tuple[Element, ...]
    linked: float


@lru_cache(maxsize=20_000)
def _kind(tag: str, rest: str) -> Kind:
    names = []
    if rest and "=" in rest:
        for m in _NAMES.finditer(rest):
            names += _WORD.findall((m[1] or m[2] or m[3] or "").lower())
    return Kind(tag, tuple(dict.fromkeys(names)))


class _Open:
    """The stack of open elements, with the places of each tag in it."""

    def __init__(self):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def last(self, tags) -> int:
        """Place of the innermost open element with one of the tags, -1 for none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, place: int) -> None:
        """Close the elements from a place on."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def path(self) -> tuple[Element, ...]:
        """The open elements that are no part of a line; of very many, the outermost and the innermost."""
        stack = self.stack if len(self.stack) <= 2 * PATH_ENDS else self.stack[:PATH_ENDS] + self.stack[-PATH_ENDS:]
        return tuple([e for e in stack if e.tag not in INLINE])


def leaves(page: str) -> list[Block]:
    """All blocks with text, in page order. ``path`` holds the open elements, outermost first.

    References are decoded; white space in a block becomes one space. Comments, scripts, styles, titles and the like give no
    text; such an element that closes itself is empty. Missing end tags are supplied: a paragraph ends where a block begins,
    items end at the next item, an end tag closes what is open inside its element, and one without a start is ignored. The time is
    in proportion to the length of the page, however broken its markup.
    """
    out: list[Block] = []
    opened = _Open()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, opened.path(), min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    anchors = 0
    for piece in Scanner(page):
        if isinstance(piece, str):
            parts.append(piece)
            if anchors:
                linked += len(piece.strip())
            continue
        tag, end, rest = piece
        if not tag:
            continue
        if tag in RAW:
            # An icon stands in its line; the others break it.
            if tag != "svg":
                flush()
        elif tag == "br" or tag == "wbr":
            parts.append(" ")
        elif tag in INLINE:
            if tag == "a":
                anchors = 0 if end else 1
            elif tag == "img":
                parts.append(" ")
        elif end:
            flush()
            if (place := opened.last((tag,))) >= 0:
                opened.cut(place)
            anchors = 0
        else:
            flush()
            if opened.stack and opened.stack[-1].tag == "p":
                opened.cut(len(opened.stack) - 1)
            place = opened.last(CLOSES.get(tag, ()))
            if place > opened.last(BOUNDS.get(tag, ())):
                opened.cut(place)
            if tag not in VOID and not rest.endswith("/"):
                opened.push(Element(_kind(tag, rest)))
    flush()
    return out

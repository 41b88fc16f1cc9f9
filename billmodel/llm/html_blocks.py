"""Leaf blocks of a page: runs of text between tags that break the line, each
with the path of elements it stands in.

The reader follows what browsers do with loose markup as far as it matters here:
comments, scripts and styles hold no text, a paragraph or list item ends where the
next starts, an end tag closes what was left open inside its element, one without
its start is ignored. Character references are decoded, white space inside a
block becomes one space. A page is read in one pass, in time proportional to its
length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

#: Elements that don't break a line, that have no content, and
#: whose content is no markup (kept as text or not).
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style template xmp".split())
RAW_TEXT = frozenset("textarea title".split())
#: Elements that end an open one of their own kind, up to the element around it.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
#: Longer attributes are read but not kept for the next element like it.
KEPT_ATTRIBUTES = 256
#: Elements of a path that are read, from its top and from its leaf.
PATH_ENDS = 12
#: Text that is squeezed at once.
SLICE = 1 << 20

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|data-keep)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s")


def squeezed(text: str) -> str:
    """White space as single spaces, none at the ends."""
    if len(text) <= SLICE:
        return " ".join(text.split())
    out, at = [], 0
    while at < len(text):
        end = len(text)
        if at + SLICE < end and (m := _WHITE.search(text, at + SLICE)):
            end = m.start()
        if part := " ".join(text[at:end].split()):
            out.append(part)
        at = end
    return " ".join(out)


@dataclass(slots=True)
class Element:
    name: str
    #: The element's name and the words of its class, id and role.
    words: tuple[str, ...]
    keep: str | None


@lru_cache(maxsize=20_000)
def element(name: str, attributes: str) -> Element:
    words, keep = ["<" + name], None
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if m.group(1).lower() == "data-keep":
            keep = value
        else:
            words += _NAME.findall(value)[:8]
    return Element(name, tuple(words), keep)


@dataclass(slots=True)
class Block:
    text: str
    #: Words of the elements around it, outermost first.
    path: tuple[tuple[str, ...], ...]
    names: frozenset
    depth: int
    #: Share of its characters in links.
    linked: float
    #: What ``data-keep`` of the innermost element that has one says (pages to train on).
    keep: str | None


class _Reader:
    def __init__(self):
        self.stack: list[Element] = []
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.linked = self.held = 0
        self.blocks: list[Block] = []

    def push(self, e: Element) -> None:
        self.stack.append(e)
        self.open[e.name] = self.open.get(e.name, 0) + 1

    def pop(self) -> str:
        name = self.stack.pop().name
        self.open[name] -= 1
        return name

    def flush(self) -> None:
        if self.parts:
            text = squeezed("".join(self.parts))
            if text:
                around = [e for e in self.stack if e.name not in INLINE] if len(self.stack) <= 4 * PATH_ENDS else self.ends()
                ends = around if len(around) <= 2 * PATH_ENDS else around[:PATH_ENDS] + around[-PATH_ENDS:]
                keep = next((e.keep for e in reversed(ends) if e.keep is not None), None)
                self.blocks.append(Block(text, tuple(e.words for e in ends), frozenset(e.name for e in ends), len(self.stack),
                                         min(1.0, self.linked / max(1, self.held)), keep))
            self.parts, self.linked, self.held = [], 0, 0

    def ends(self) -> list[Element]:
        """The two ends of a very deep path."""
        return [e for e in self.stack[: 2 * PATH_ENDS] + self.stack[-2 * PATH_ENDS :] if e.name not in INLINE]

    def text(self, text: str) -> None:
        if text:
            self.parts.append(unescape(text) if "&" in text else text)
            self.held += len(text)
            if self.open.get("a"):
                self.linked += len(text)

    def start(self, name: str, attributes: str) -> None:
        if name not in INLINE:
            self.flush()
            if name != "br":
                self.close(SIBLINGS.get(name, frozenset()) | {"p"})
        if name not in VOID:
            self.push(element(name, attributes) if len(attributes) <= KEPT_ATTRIBUTES else element.__wrapped__(name, attributes))

    def close(self, names: set[str]) -> None:
        """Ends open elements of ``names`` that have nothing but inline elements
        open inside them."""
        while any(self.open.get(n) for n in names):
            top = len(self.stack)
            while top and self.stack[top - 1].name in INLINE:
                top -= 1
            if not top or self.stack[top - 1].name not in names:
                return
            while len(self.stack) >= top:
                self.pop()

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
        if not self.open.get(name):
            return
        if name in INLINE:
            at = len(self.stack)
            while at and self.stack[at - 1].name in INLINE:
                at -= 1
                if self.stack[at].name == name:
                    self.open[name] -= 1
                    del self.stack[at]
                    return
            return
        while self.pop() != name:
            pass


_closing: dict[str, re.Pattern] = {}


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in their order."""
    r, at = _Reader(), 0
    n = len(page)
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            r.text(page[at:])
            break
        r.text(page[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            r.end(name)
            continue
        r.start(name, m.group(3) if m.group(2) else m.group(6))
        if name in RAW or name in RAW_TEXT:
            close = _closing.get(name) or _closing.setdefault(name, re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I))
            e = close.search(page, at)
            if name in RAW_TEXT:
                r.text(page[at : e.start() if e else n])
            r.end(name)
            at = e.end() if e else n
    r.flush()
    return r.blocks

"""HTML cut into blocks: runs of text between block borders, with the path of open tags."""

from __future__ import annotations

import functools
import html
import itertools
import re
from dataclasses import dataclass

# Fixed values of HTML: elements that break lines, that have no end tag, whose content is
# no text of the page, and which starts end which open elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = frozenset(
    "script style title noscript noframes template svg math iframe object textarea audio video".split()
)
RAW_TAGS = frozenset("script style textarea title iframe noscript noframes".split())
ENDED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
LISTS = frozenset("ul ol dl table select menu".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.DOTALL,
)
# Case counts in no tag name; ASCII, or a long s would be an s.
_RAW_ENDS = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.IGNORECASE | re.ASCII) for t in RAW_TAGS}
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    """``path``: names of the open block elements and their classes, ids and roles, outermost
    first. ``linked``: characters of the text inside links."""

    path: tuple[str, ...]
    text: str
    linked: int
    depth: int


@functools.lru_cache(4096)
def _names(tag: str, attrs: str) -> tuple[str, ...]:
    names = [tag]
    for m in _NAMED.finditer(attrs):
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        names += [f"{m[1].lower()}:{part}" for part in _NAME_PART.findall(value)]
    return tuple(names)


class _Reader:
    def __init__(self):
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = tuple(itertools.chain.from_iterable([names for _, names in self.open]))
            linked = len(" ".join("".join(self.linked).split())) if self.linked else 0
            self.blocks.append(Block(path, text, linked, len(self.open)))
        self.parts, self.linked = [], []

    def start(self, tag: str, attrs: str) -> None:
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.parts.append(" ")
        if tag not in BLOCK_TAGS:
            return
        self.flush()
        ends = ENDED_BY.get(tag, ())
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name in ends or name == "p":
                del self.open[k:]
                if name != "p":
                    break
            elif name in LISTS:
                break
        if tag not in VOID_TAGS:
            self.open.append((tag, _names(tag, attrs)))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = max(self.links - 1, 0)
        if tag not in BLOCK_TAGS:
            return
        self.flush()
        self.links = 0  # a link left open ends with its block
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.links:
            self.linked.append(text)


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order. Broken markup never fails: unknown ends are ignored,
    missing ones implied, and a tag that the page's end cuts off is dropped.

    ``<head>`` hides nothing itself, as all that can stand in it is hidden by its own tag.
    A hidden element that is never closed ends with the next block tag.
    """
    reader, at = _Reader(), 0
    hidden, starts = "", []  # the hidden element and where it and those of its name in it start
    resume = -1  # the first block tag in it: what is read again if its end is missing
    unclosed: set[int] = set()
    loose = False  # whether the hidden element is known to be one of these
    while at < len(page) or hidden and not loose:
        if at >= len(page):
            # The page ends within it. Each name reads to the end at most once, since all
            # starts without an end are known then.
            unclosed.update(starts)
            if resume < 0:
                break
            hidden, at = "", resume
            continue
        mark = page.find("<", at)
        if mark < 0:
            if not hidden:
                reader.text(page[at:])
            at = len(page)
            continue
        m = _TOKEN.match(page, mark)
        if not m:  # a lone "<"
            if not hidden:
                reader.text(page[at : mark + 1])
            at = mark + 1
            continue
        if mark > at and not hidden:
            reader.text(page[at:mark])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        ends, attrs = bool(m["end"] or m["end2"]), m["attrs"] or ""
        if hidden and tag in BLOCK_TAGS:
            if loose:
                hidden = ""
            elif resume < 0:
                resume = mark
        if not ends and tag in RAW_TAGS:
            # Its content ends at its end tag alone, whatever else is in there.
            close = _RAW_ENDS[tag].search(page, at)
            at = close.start() if close else len(page)
        elif hidden:
            if tag != hidden or loose:
                pass
            elif not ends:
                if not attrs.endswith("/"):
                    starts.append(mark)
            else:
                starts.pop()
                if not starts:
                    hidden = ""
        elif ends:
            reader.end(tag)
        elif tag in HIDDEN_TAGS and not attrs.endswith("/"):
            hidden, starts, resume, loose = tag, [mark], -1, mark in unclosed
        else:
            reader.start(tag, attrs)
    reader.flush()
    return reader.blocks

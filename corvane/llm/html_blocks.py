"""HTML to leaf blocks with their tag paths, forgiving of unclosed and stray tags.

Time is in proportion to the page, however deep its elements lie: what a start tag closes is kept with
every open element, and paths are linked elements, not copies.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# HTML element classes.
RAW = {"script", "style", "template", "textarea", "select", "iframe", "svg", "math", "title", "xmp", "noembed", "noframes"}
#: Raw elements that reach to the page's end if nothing closes them; other unclosed ones are read as ordinary elements.
TO_THE_END = {"script", "style"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
    "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "label",
}
SPACE = {"br", "img", "input"}
#: What a start tag of an element closes, if that is open inside the nearest of its bounds.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"form"}),
    "body": ({"head"}, set()),
}
P_BOUNDS = {"table", "td", "th", "button", "caption", "body", "html"}
#: Groups of (closed, bounds), the last for paragraphs, which any other block closes.
GROUPS = [*CLOSES.values(), ({"p"}, P_BOUNDS)]
GROUP_OF = {tag: k for k, tag in enumerate(CLOSES)}
PARAGRAPH = len(GROUPS) - 1
_MARKED = set().union(*(names | bounds for names, bounds in GROUPS))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")


class Element:
    """An open element under its parent: its tag, its names (tag and the words of class, id and role), and
    for each of GROUPS the depth of the element that a start tag of the group would close, or -1."""

    __slots__ = ("closes", "depth", "mask", "names", "parent", "tag")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.depth = 0 if parent is None else parent.depth + 1
        self.names = (tag,)
        if "=" in attributes:
            self.names += tuple(w for _, value in ATTRIBUTE.findall(attributes) for w in WORD.findall(value.lower()))
        self.mask = None  # a place for what features remember of a path
        self.closes = _NOTHING if parent is None else parent.closes
        if tag in _MARKED:
            self.closes = tuple(
                self.depth if tag in names else -1 if tag in bounds else at for at, (names, bounds) in zip(self.closes, GROUPS, strict=True)
            )


_NOTHING = (-1,) * len(GROUPS)


class Block(NamedTuple):
    text: str
    #: The innermost open element, None outside of all.
    path: Element | None
    #: Code points of the text inside links.
    linked: int


def blocks(page: str) -> list[Block]:
    """The non-empty leaf blocks in page order; white space collapsed, character references decoded.

    Script, style and other raw elements, comments and the title give no block.
    """
    found: list[Block] = []
    stack: list[Element] = []
    open_tags: Counter[str] = Counter()
    never_closed: set[str] = set()
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, stack[-1] if stack else None, linked))
            parts.clear()
        linked = 0

    def close(group: int) -> None:
        depth = stack[-1].closes[group] if stack else -1
        while depth >= 0 and len(stack) > depth:
            open_tags[stack.pop().tag] -= 1

    at, end = 0, len(page)
    while at < end:
        match = TOKEN.match(page, at)
        at = match.end()
        tag = match[2] or match[5]
        if not tag:
            if page[match.start()] != "<" or match.end() == match.start() + 1:
                parts.append(match[0])
                if in_link:
                    linked += match.end() - match.start()
            continue
        tag = tag.lower()
        closing, attributes = (match[1], match[3]) if match[2] else (match[4], match[6])
        if closing:
            if tag in INLINE:
                in_link -= tag == "a" and in_link > 0
                continue
            if tag in RAW:
                continue
            flush()
            while open_tags[tag] > 0:
                last = stack.pop().tag
                open_tags[last] -= 1
                if last == tag:
                    break
            in_link = 0
            continue
        if tag in RAW and not (attributes.endswith("/") and tag in ("svg", "math")):
            stop = None if tag in never_closed else re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            if stop or tag in TO_THE_END:
                at = stop.start() if stop else end
                parts.append(" ")
                continue
            never_closed.add(tag)
        if tag in INLINE:
            in_link += tag == "a"
            continue
        if tag in SPACE:
            parts.append(" ")
            continue
        flush()
        in_link = 0
        if tag in GROUP_OF:
            close(GROUP_OF[tag])
        elif tag not in VOID:
            close(PARAGRAPH)
        if tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "math")):
            stack.append(Element(tag, attributes, stack[-1] if stack else None))
            open_tags[tag] += 1
    flush()
    return found

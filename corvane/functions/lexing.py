"""One scan of source texts: what is comment or literal, what is code, and where its braces close."""

from __future__ import annotations

import re
from collections.abc import Iterator

# A part of a text that is no code, by how it begins; `fence` are the signs around a raw string.
_OPAQUE = re.compile(
    r"""
      (?P<line> //[^\n]* )
    | (?P<block> /\* )
    | (?P<raw> r(?P<fence>\#*)" .*? (?: "(?P=fence) | \Z ) )
    | (?P<string> " (?: \\. | [^"\\] )* (?: " | \\?\Z ) )
    | (?P<character> ' (?: \\. | [^'\\] ) ' )
    """,
    re.S | re.X,
)
_EDGES = re.compile(r"/\*|\*/")
_BRACES = re.compile("[{}]")
_VISIBLE = re.compile(r"[^\n]")


def opaque_parts(text: str, nested: bool = True) -> Iterator[tuple[int, int]]:
    """(begin, end) of all comments and literals, in order. With `nested`, block comments hold block comments.

    Whatever is not closed ends with the text; a lone quote, as of a lifetime, begins nothing.
    """
    at = 0
    while part := _OPAQUE.search(text, at):
        at = _comment_end(text, part.end(), nested) if part["block"] else part.end()
        yield part.start(), at


def _comment_end(text: str, at: int, nested: bool) -> int:
    open_comments = 1
    for edge in _EDGES.finditer(text, at):
        if edge[0] == "*/":
            open_comments -= 1
        elif nested:
            open_comments += 1
        if not open_comments:
            return edge.end()
    return len(text)


def code_of(text: str, nested: bool = True) -> str:
    """The text with blanks for its comments and literals; every offset and line stays."""
    pieces, done = [], 0
    for begin, end in opaque_parts(text, nested):
        pieces.append(text[done:begin])
        pieces.append(_VISIBLE.sub(" ", text[begin:end]))
        done = end
    return "".join(pieces) + text[done:]


def closing_braces(code: str) -> dict[int, int]:
    """Offset of the closing brace of each opening one that closes, from one pass over code."""
    waiting: list[int] = []
    pairs = {}
    for brace in _BRACES.finditer(code):
        if brace[0] == "{":
            waiting.append(brace.start())
        elif waiting:
            pairs[waiting.pop()] = brace.start()
    return pairs


#: Heads of unsafe bodies in code: a block, or a function of any calling convention; not those of implementations.
_UNSAFE_HEAD = re.compile(r"\bunsafe(?:\s+(?:extern\s+)?fn\b[^;{]*|\s*)\{")


def unsafe_bodies(code: str) -> list[tuple[int, int]]:
    """(begin, end) of unsafe bodies from their heads to their closing braces; an open one reaches to the end of the code."""
    pairs = closing_braces(code)
    return [(head.start(), pairs.get(head.end() - 1, len(code))) for head in _UNSAFE_HEAD.finditer(code)]

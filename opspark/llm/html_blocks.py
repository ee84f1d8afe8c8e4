"""Leaf blocks of HTML pages: a sequence of (text, tag path, attributes of the path), in page order.

Tags are read in one pass with a stack; unclosed and misnested tags, comments, and raw-text elements are borne with. Blocks end at
block-level tags and line breaks; inline tags join their text to the block around them.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Fixed values of HTML: elements without content, elements whose content is raw text or is not shown, inline elements. The content of the first
#: row goes even where the element is never closed, as HTML says; one of the second row that is not closed counts as an ordinary element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style textarea title".split())
RAW = UNREAD | frozenset("noscript template svg iframe object canvas select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img"
    " math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover".split())

#: A tag of one of these closes an open p, li, td, ... of its kind, as HTML says.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_P_ENDS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|[^<]+", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"[^>=]*")
_SPACES = re.compile(r"\s*")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # open tags, outermost first
    marks: tuple[str, ...]  # words of class, id and role on the path
    link: int  # characters inside links


#: Longest path and list of words that a block carries; of longer ones the outer and the inner half.
LONGEST = 512


def _tag_end(source: str, at: int) -> int:
    """The place behind the ``>`` of the tag whose name ends at ``at``; -1 if there is none. Quotes count behind an ``=`` only.

    Each character is looked at once, a missing closing quote aside, which can happen only behind the last quote of its kind.
    """
    size = len(source)
    while at < size:
        at = _MARK.match(source, at).end()
        if at >= size:
            return -1
        if source[at] == ">":
            return at + 1
        at = _SPACES.match(source, at + 1).end()
        if at < size and source[at] in "\"'":
            close = source.find(source[at], at + 1)
            at = close + 1 if close >= 0 else at + 1
    return -1


def _added(path: tuple, more: tuple) -> tuple:
    path += more
    return path if len(path) <= LONGEST else path[: LONGEST // 2] + path[-LONGEST // 2 :]


def blocks(source: str | None) -> list[Block]:
    """The blocks that have text, in page order; none for null, empty and text-free pages.

    Time is linear in the page, however its tags are broken or nested.
    """
    out: list[Block] = []
    # open elements: name, path of shown elements and words of attributes up to and with it
    stack: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = []
    opened: dict[str, int] = {}
    unclosed: set[str] = set()  # raw elements of which no end tag is left
    parts: list[str] = []
    linked = 0

    def end() -> None:
        nonlocal linked
        if parts:
            # pieces of a block are decoded together, as a reference does not reach over a tag
            text = " ".join("".join(parts).split())
            if text:
                _, path, marks = stack[-1] if stack else ("", (), ())
                out.append(Block(text, path, marks, linked))
            parts.clear()
        linked = 0

    def cut(depth: int) -> None:
        for name, _, _ in stack[depth:]:
            opened[name] -= 1
        del stack[depth:]

    source, at = source or "", 0
    size, closing = len(source), source.rfind(">")
    while at < size:
        token = _TAG.match(source, at)
        if token is None:
            other = _OTHER.match(source, at)
            piece = other[0] if other else "<"
            at = other.end() if other else at + 1
            if piece[0] != "<" or piece == "<":  # anything else without a name is a comment, a declaration or cut off
                piece = html.unescape(piece)
                parts.append(piece)
                if opened.get("a"):
                    linked += len(piece)
            continue
        inside = token.end()
        if inside > closing:
            # no tag ends any more: the last bracket is a tag that was cut off, others are text
            if source.find("<", inside) < 0:
                break
            parts.append("<")
            at += 1
            continue
        at = _tag_end(source, inside)
        if at < 0:
            break
        attributes = source[inside : at - 1]
        name = token[2].lower()
        if token[1]:
            if name not in INLINE:
                end()
            if opened.get(name):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        cut(depth)
                        break
                    if name in INLINE and stack[depth][0] not in INLINE:
                        break
            continue
        if name not in INLINE:
            end()
            if name in _P_ENDS and opened.get("p"):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        cut(depth)
                        break
                    if stack[depth][0] not in INLINE:
                        break
            if (closed := CLOSES.get(name)) and any(opened.get(c) for c in closed):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in closed:
                        cut(depth)
                        break
                    if stack[depth][0] in ("ul", "ol", "dl", "table", "tr" if name in ("td", "th") else "table"):
                        break
        if name in VOID:
            if name == "br" or name == "hr":
                end()
            continue
        if name in RAW and attributes.rstrip().endswith("/"):
            continue
        if name in RAW and (name in UNREAD or name not in unclosed):
            close = None if name in unclosed else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
            if close:
                at = close.end()
                continue
            unclosed.add(name)
            if name in UNREAD:
                break
        marks: list[str] = []
        if "=" in attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                value = (m[2] or m[3] or m[4] or "").lower()
                key = m[1].lower()
                if key in ("class", "id", "role", "itemprop"):
                    marks += _WORD.findall(value)
                elif key == "style" and "display:none" in value.replace(" ", "") or key == "aria-hidden" and value == "true":
                    marks.append("hidden")
        _, path, words = stack[-1] if stack else ("", (), ())
        stack.append((name, path if name in INLINE else _added(path, (name,)), _added(words, tuple(marks)) if marks else words))
        opened[name] = opened.get(name, 0) + 1
    end()
    return out

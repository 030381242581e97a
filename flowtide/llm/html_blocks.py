"""Leaf blocks of an HTML page: runs of text between block elements, with the path of tags, classes and ids that leads to them.

Tolerant of what pages do: unclosed and wrongly nested tags, missing ends, unquoted attributes, stray ``<``. Scripts, styles, comments and the
title are no blocks. Character references are decoded, white space (as Python and Unicode have it) becomes one space.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

#: Elements that begin and end a block; all others stand within one.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe input legend li main menu nav noscript object ol optgroup option "
    "output p pre section select summary table tbody td template textarea tfoot th thead title tr ul video audio".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup and no text of the page.
RAW_TAGS = frozenset("script style xmp iframe noembed noframes title template svg math".split())
#: A start tag ends an open element of these kinds, up to the nearest container.
_ENDS = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
_TOKEN = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_REST = re.compile(r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+>""")
_NAMED = re.compile(r"""(?<![^\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_CLOSERS = {t: re.compile(f"</{t}(?=[\\s/>])", re.IGNORECASE) for t in RAW_TAGS | {"textarea"}}


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # "tag" for elements and ".name" for parts of their classes, ids and roles, from outside in
    leaf: str  # the innermost block element
    link_chars: int


def _names(attributes: str) -> list[str]:
    found = []
    for _, *values in _NAMED.findall(attributes):
        found += [f".{p.lower()}" for p in _PART.findall(unescape("".join(values)))]
    return found


def blocks(html: str | None) -> list[Block]:
    """The blocks of a page in order; none for null or empty text."""
    html = html or ""
    out: list[Block] = []
    # tag, path up to it, innermost block element
    stack: list[tuple[str, tuple[str, ...], str]] = [("", (), "body")]
    pieces: list[str] = []
    where = stack[0]
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, where[1], where[2], min(linked, len(text))))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal where, linked
        if raw:
            text = unescape(raw)
            if not text.isspace():
                if not pieces or not any(p and not p.isspace() for p in pieces):
                    where = stack[-1]
                if links:
                    linked += len(text.strip())
            pieces.append(text)

    def close(at: int) -> None:
        nonlocal links
        links -= sum(s[0] == "a" for s in stack[at:])
        del stack[at:]

    def close_open(names: tuple[str, ...], within: tuple[str, ...]) -> None:
        outer = 0
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in names:
                outer = at
            elif stack[at][0] in within:
                break
        if outer:
            close(outer)

    pos = 0
    while found := _TOKEN.search(html, pos):
        add(html[pos : found.start()])
        closing, name = found.group(1), found.group(2)
        if name is None:
            if found.group() == "<!--":
                end = html.find("-->", found.start() + 2)
                pos = len(html) if end < 0 else end + 3
            else:
                end = html.find(">", found.end())
                pos = len(html) if end < 0 else end + 1
            continue
        rest = _REST.match(html, found.end())
        if rest is None:
            end = html.find(">", found.end())
            if end < 0:
                pos = len(html)
                break
            pos = end + 1
        else:
            pos = rest.end()
        attributes = html[found.end() : pos - 1]
        tag = name.lower()
        is_block = tag in BLOCK_TAGS
        if is_block:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if closing:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
                if not is_block and stack[at][0] in BLOCK_TAGS:
                    break  # an inline end tag does not end a block
            continue
        if tag in RAW_TAGS or tag == "textarea":
            end = _CLOSERS[tag].search(html, pos)
            inside = html[pos : end.start() if end else len(html)]
            pos = end.start() if end else len(html)
            if tag == "textarea" and inside.strip():
                stack.append((tag, (*stack[-1][1], tag), tag))
                add(inside)
                flush()
                stack.pop()
            continue
        if is_block:
            close_open(("p",), ("td", "th", "button", "object"))
        if tag in _ENDS:
            close_open(tuple(_ENDS[tag][0].split()), _ENDS[tag][1])
        if tag in VOID_TAGS or (attributes.endswith("/") and not is_block):
            continue
        above = stack[-1]
        own = (tag, *_names(attributes)) if "=" in attributes else (tag,)
        stack.append((tag, above[1] + own, tag if is_block else above[2]))
        links += tag == "a"
    add(html[pos:])
    flush()
    return out

"""Leaf blocks of an HTML page: text runs between block-level tags, each with its tag path."""

from __future__ import annotations

import html
import re

# Element kinds of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea"
HIDDEN = "noscript|template|svg|iframe|select|object|canvas"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # raw text runs to its closing tag or the page's end; other hidden elements to their closing tag, if they have one
    rf"|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    rf"|<({HIDDEN})(?=[\s/>])(?:[^>]*/>|[^>]*>(?:.*?</\2\s*>)?)"
    r"|<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*+)([^>]*+)>"
    r"|<[!?][^>]*+>", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")

Path = tuple  # of (tag, words of class, id and role)


def blocks(page: str | None) -> list[tuple[Path, str, float]]:
    """(path, text, share of its characters in links) of every non-empty block, in page order.  Character
    references are decoded; white space inside a block is one space; unclosed elements are closed as
    far as their parents are."""
    out: list[tuple[Path, str, float]] = []
    stack: list[tuple] = []
    held: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((tuple(stack), text, min(1.0, linked / len(text))))
            held.clear()
        linked = 0

    at, page = 0, page or ""
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text = page[at:m.start()]
            held.append(text)
            if in_link:
                linked += len(text)
        at = m.end()
        tag = (m[4] or m[7] or "").lower()
        if not tag:
            continue
        closing, rest = bool(m[3] or m[6]), m[5] or m[8] or ""
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        flush()
        if tag == "br" or tag == "hr":
            continue
        in_link = 0
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID and not rest.endswith("/"):
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                stack.pop()
            words = tuple(w for n in _NAMES.findall(rest) for w in _WORD.findall("".join(n).lower()))
            stack.append((tag, words))
    if at < len(page):
        held.append(page[at:])
    flush()
    return out

"""Tokens of an HTML page, as browsers would read its broken mark-up, without a parser library."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is not text of the page (browsers never show it), or is not mark-up.
RAW = frozenset("script style textarea title iframe template xmp".split())
#: Elements whose content is not mark-up but text; of these, xmp has no references.
_RAW_TEXT = frozenset("textarea title xmp".split())
#: Elements that a slash at the end of the opening tag closes.
_FOREIGN = frozenset("svg math".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul xmp".split()
)
#: An opening tag ends an open element of these names (up to the nearest container).
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"), "body": ("head",),
}
_CONTAINERS = frozenset("ul ol dl table select div section article body html aside nav main header footer form".split())
_END_P = BLOCKS - {"body", "html", "head", "title", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_END_RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


class Token(NamedTuple):
    """``kind``: open, close or text. ``value``: the element's name, or the text with references decoded."""

    kind: str
    value: str
    attributes: str = ""


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name, quotes taken off and references decoded; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" and value[:1] else value))
    return found


def lex(page: str) -> Iterator[Token]:
    """Tags and texts in page order; comments, declarations and the content of raw elements left out, unless it is text.

    A script or style without an end goes to the end of the page; other raw elements without one are empty.
    """
    at, size = 0, len(page)
    search, unescape = _TAG.search, html.unescape
    unended: set[str] = set()  # searched to the end of the page once
    while at < size:
        tag = search(page, at)
        if tag is None:
            yield Token("text", unescape(page[at:]))
            return
        start, stop = tag.span()
        if start > at:
            yield Token("text", unescape(page[at:start]))
        at = stop
        closing, name, given = tag.groups()
        if not name:
            continue
        name = name.lower()
        if closing:
            yield Token("close", name)
            continue
        yield Token("open", name, given)
        if name in RAW and not given.endswith("/"):
            end = _END_RAW[name].search(page, at) if name not in unended else None
            if end is None and name not in ("script", "style"):
                unended.add(name)
                yield Token("close", name)
                continue
            stop = end.start() if end else len(page)
            if name in _RAW_TEXT:
                yield Token("text", page[at:stop] if name == "xmp" else html.unescape(page[at:stop]))
            yield Token("close", name)
            at = end.end() if end else len(page)


def balanced(page: str) -> Iterator[Token]:
    """The tokens of ``lex`` with every element opened and closed in order; elements left open end with their parent."""
    return in_order(lex(page))


def in_order(tokens: Iterable[Token]) -> Iterator[Token]:
    """``balanced`` of a page whose tokens are known."""
    stack: list[str] = []

    def end(names: tuple[str, ...] | frozenset[str], stop: frozenset[str]) -> Iterator[Token]:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] in names:
                while len(stack) > depth:
                    yield Token("close", stack.pop())
                return
            if stack[depth] in stop:
                return

    for token in tokens:
        kind, name, given = token
        if kind == "text":
            yield token
        elif kind == "open":
            if name in _END_P and "p" in stack:
                yield from end(("p",), _CONTAINERS)
            if name in CLOSES:
                yield from end(CLOSES[name], _CONTAINERS - {name})
            yield token
            if name in VOID or name in _FOREIGN and given.endswith("/"):
                yield Token("close", name)
            else:
                stack.append(name)
        elif stack and stack[-1] == name:
            stack.pop()
            yield token
        elif name in stack:
            yield from end((name,), frozenset())
    while stack:
        yield Token("close", stack.pop())


def plain_text(page: str) -> str:
    """All text of the body, a line per block, white space inside a block as one space."""
    return text_of(lex(page))


def text_of(tokens: Iterable[Token]) -> str:
    """``plain_text`` of a page whose tokens are known."""
    lines: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if line := " ".join("".join(run).split()):
            lines.append(line)
        run.clear()

    hidden = 0
    for kind, value, _ in in_order(tokens):
        if kind == "text":
            if not hidden:
                run.append(value)
        elif value in BLOCKS:
            flush()
            if value == "title":
                hidden += 1 if kind == "open" else -1
        elif value == "br" and kind == "open":
            run.append(" ")
    flush()
    return "\n".join(lines)

"""Leaf blocks of an HTML page: runs of text between block-level tags, with the chain of elements around them.

This is a small tolerant reader, not a full parser: tags are found by a pattern, elements that a new block closes are closed
(``p``, list items, table cells), an end tag without its start is ignored, inline tags do not part a block.
Quotes delimit a value only after an equals sign; a ``<`` that no ``>`` closes before the next ``<`` is text.  An element that is left
out ends with the end tag of its own depth; without one it hides nothing, unless it is ``script``, ``style``, ``textarea`` or
``title``; formulas are text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Elements as HTML sorts them.
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = set("script style noscript template textarea select button svg iframe object canvas audio video title option datalist".split())
#: Those that hold no elements: without an end tag they take the rest of the page; of others only the tag itself is skipped.
RAW = {"script", "style", "textarea", "title"}
#: A new element of the key closes an open one of the value.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
#: Where closing stops: an inner list does not close an outer item.
WALLS = {"ul", "ol", "dl", "table", "menu"}


@dataclass(frozen=True)
class Element:
    tag: str
    marks: tuple[str, ...]  # words of class, id and role


@dataclass
class Block:
    text: str
    path: tuple[Element, ...]
    linked: int  # characters inside links


def marks_of(attributes: str) -> tuple[str, ...]:
    found = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop"):
            value = re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c)
            found += re.findall(r"[a-z]+", value.lower())
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", a or b or c):
            found.append("hidden")
    return tuple(dict.fromkeys(found))


def _end_of(html: str, tag: str, at: int) -> int | None:
    """Where the element ends whose start tag ends at ``at``; elements of the same name in it are passed, unless it holds none."""
    depth = 1
    for found in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^<>]*>", re.I).finditer(html, at):
        if found.group(1):
            depth -= 1
            if depth == 0 or tag in RAW:
                return found.end()
        elif tag not in RAW and not found.group(0).endswith("/>"):
            depth += 1
    return None


def blocks_of(html: str) -> list[Block]:
    """The blocks of a whole page in page order; blocks without text are left out."""
    out: list[Block] = []
    stack: list[Element] = []
    parts: list[tuple[str, bool]] = []
    known: dict[tuple, Element] = {}
    endless: set[str] = set()
    at, in_link = 0, False

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(p) for p, link in parts if link)
                out.append(Block(text, tuple(stack), min(linked, len(text))))
            parts.clear()

    while True:
        found = TAG.search(html, at)
        if found is None:
            if at < len(html):
                parts.append((html[at:], in_link))
            break
        if found.start() > at:
            parts.append((html[at : found.start()], in_link))
        at = found.end()
        if found.group(2) is None:
            continue
        tag, closing = found.group(2).lower(), found.group(1) == "/"
        if tag in SILENT:
            if not closing and not found.group(3).endswith("/") and tag not in endless:
                end = _end_of(html, tag, at)
                if end is not None:
                    at = end
                elif tag in RAW:
                    at = len(html)
                else:
                    endless.add(tag)  # no end tag follows, so none is looked for again
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
        else:
            if stack and stack[-1].tag == "p" and tag != "br":
                stack.pop()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i].tag in WALLS:
                    break
            if tag not in VOID:
                key = (tag, found.group(3))
                if key not in known:
                    known[key] = Element(tag, marks_of(found.group(3)) if found.group(3) else ())
                stack.append(known[key])
    flush()
    return out

"""Flat text blocks of web pages (shared by problems 1 and 6).

A page is cut at block-level tags; scripts, styles, comments and notices for browsers without
scripts hold no text.  Each block keeps its words, its linked words and the path of its open
elements, so that a page is a short flat list and needs no tree in memory.
"""

from __future__ import annotations

import html as _html
import re
from typing import NamedTuple

_ATTRIBUTES = r"[^'\">]*(?:(?:\"[^\"]*\"|'[^']*')[^'\">]*)*"
_TAG = re.compile(rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*){_ATTRIBUTES}>", re.S)
#: Elements whose content is never shown as text of the page.
HIDDEN = {"script", "style", "noscript", "template", "iframe", "svg", "head", "title", "object", "textarea", "select"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "small", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "br", "option", "button", "caption",
}
#: Opening one of these ends an open element of the same group.
IMPLIED = {"p": {"p"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN}
_KEEPS_LINK = {"p", "div", "li", "h1", "h2", "h3", "h4"}
_SCOPES = {"table", "ul", "ol", "dl", "div", "body"}


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    path: tuple[str, ...]
    #: number of the innermost open element; blocks of one element share it
    element: int
    parent: int
    #: number of rules (hr) before the block
    section: int
    #: its lines
    pieces: tuple[str, ...]


def page_blocks(page: str | None, keep_hidden: frozenset[str] = frozenset()) -> list[Block]:
    """Text blocks in page order.  null and empty pages have none; elements never closed end with their parent."""
    if not page:
        return []
    out: list[Block] = []
    names: list[str] = []
    numbers: list[int] = [0]
    count, pos, end = 0, 0, len(page)
    buf: list[str] = []
    link_words = words = 0
    in_link = 0
    breaks = section = 0
    hidden = HIDDEN - keep_hidden
    search = _TAG.search

    def flush() -> None:
        nonlocal buf, link_words, words
        if words:
            raw = "".join(buf)
            if "&" in raw:
                raw = _html.unescape(raw)
            if "\n" in raw:
                lines = tuple(x for x in (" ".join(y.split()) for y in raw.split("\n")) if x)
                text = "\n".join(lines)
            else:
                text = " ".join(raw.split())
                lines = (text,)
            if text:
                out.append(Block(text, words, link_words, tuple(names), numbers[-1], numbers[-2] if len(numbers) > 1 else 0, section, lines))
        buf, words, link_words = [], 0, 0

    while pos < end:
        m = search(page, pos)
        start = m.start() if m else end
        if start > pos:
            chunk = page[pos:start]
            n = len(chunk.split())
            if n:
                words += n
                if in_link:
                    link_words += n
                breaks = 0
            buf.append(chunk)
        if not m:
            break
        pos = m.end()
        closing, name = m.groups()
        if not name:
            continue
        name = name.lower()
        if closing:
            if name == "a":
                in_link = 0
                buf.append(" ")
            elif name == "span":
                buf.append(" ")
            elif name in BLOCK:
                flush()
                for k in range(len(names) - 1, -1, -1):
                    if names[k] == name:
                        del names[k:], numbers[k + 1 :]
                        break
            continue
        if name in hidden:
            stop = _CLOSING[name].search(page, pos)
            pos = stop.end() if stop else (end if name not in ("head", "select") else pos)
            continue
        if name == "a":
            in_link = 1
            buf.append(" ")
        elif name == "span":
            buf.append(" ")
        elif name == "br":
            # One line break keeps the block, an empty line ends it.
            breaks += 1
            if breaks > 1:
                flush()
            else:
                buf.append("\n")
        elif name in BLOCK:
            flush()
            section += name == "hr"
            in_link = in_link if name in _KEEPS_LINK else 0
            group = IMPLIED.get(name)
            if group:
                for k in range(len(names) - 1, -1, -1):
                    if names[k] in group:
                        del names[k:], numbers[k + 1 :]
                        break
                    if names[k] in _SCOPES:
                        break
            if name not in VOID:
                count += 1
                names.append(name)
                numbers.append(count)
    flush()
    return out

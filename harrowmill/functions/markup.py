"""Document tree and selectors on the standard library's parser (Python side of Arrow UDFs)."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit, urlunsplit

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Opening the key ends an open element of the value set, up to the nearest scope.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"table", "ul", "ol", "dl", "body", "html", "select", "article", "section", "div"}
BLOCK_ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    children: list = field(default_factory=list)  # nodes and strings

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def walk(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#document")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        wanted = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCK_ENDS_P else set())
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in wanted:
                del self.open[k:]
                break
            if self.open[k].tag in SCOPE:
                break
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(page: str | None) -> Node:
    b = _Builder()
    b.feed(page or "")
    b.close()
    return b.root


_PART = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:#[\w-]+|\.[\w-]+|\[[^\]]+\]|:first-child)*)")
_BIT = re.compile(r"#([\w-]+)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*[\"']?([^\"'\]]*)[\"']?\s*)?\]|(:first-child)")


def _compile(css: str) -> list[list[tuple[str, str, list]]]:
    """Per alternative: (combinator, tag, tests) from left to right."""
    out = []
    for alternative in css.split(","):
        chain, combinator = [], " "
        for token in re.findall(r">|[^\s>]+(?:\[[^\]]*\])?", alternative):
            if token == ">":
                combinator = ">"
                continue
            m = _PART.fullmatch(token)
            if not m:
                return []
            chain.append((combinator, (m.group(1) or "*").lower(), _BIT.findall(m.group(2))))
            combinator = " "
        if chain:
            out.append(chain)
    return out


def _fits(node: Node, tag: str, tests: list) -> bool:
    if tag != "*" and node.tag != tag:
        return False
    for ident, cls, attr, value, first in tests:
        if ident and node.attrs.get("id") != ident:
            return False
        if cls and cls not in node.attrs.get("class", "").split():
            return False
        if attr and (attr not in node.attrs or (value and node.attrs[attr] != value)):
            return False
        if first and (node.parent is None or next((c for c in node.parent.children if isinstance(c, Node)), None) is not node):
            return False
    return True


def _matches(node: Node, chain: list) -> bool:
    if not _fits(node, chain[-1][1], chain[-1][2]):
        return False
    if len(chain) == 1:
        return True
    up = node.parent
    while up is not None:
        if _matches(up, chain[:-1]):
            return True
        if chain[-1][0] == ">":
            return False
        up = up.parent
    return False


def select(root: Node, css: str | None) -> list[Node]:
    """Elements in document order; a selector outside the supported subset matches nothing."""
    chains = _compile(css) if css and css.strip() else []
    return [n for n in root.walk() if any(_matches(n, c) for c in chains)]


def value(node: Node, attribute: str | None) -> str:
    return (node.attrs.get(attribute, "") if attribute else node.text()).strip()


def single(root: Node, css: str | None, attribute: str | None = None, multi: bool = False) -> str:
    """First match trimmed, or with multi all non-empty matches, one a line."""
    found = [value(n, attribute) for n in select(root, css)]
    return "\n".join(v for v in found if v) if multi else (found[0] if found else "")


def absolute(href: str, base: str) -> str | None:
    """http(s) URL without fragment; null for other schemes and broken URLs."""
    try:
        u = urlsplit(urljoin(base, href.strip()))
    except ValueError:
        return None
    return urlunsplit((u.scheme, u.netloc, u.path, u.query, "")) if u.scheme in ("http", "https") and u.netloc else None


def collapse(text: str) -> str:
    return " ".join(text.split())

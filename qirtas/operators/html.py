"""HTML pages to titles, links and Markdown, with the standard library's parser in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame

_VOID = frozenset(("br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"))
# Elements and classes that hold no content, and parts of class names that advertise or track.
NOISE_TAGS = frozenset((
    "script", "style", "noscript", "iframe", "svg", "canvas", "form", "button", "input", "select", "textarea",
    "nav", "header", "footer", "aside",
))
NOISE_CLASSES = frozenset((
    "site-header", "site-footer", "main-navigation", "navigation", "nav-links", "sidebar", "widget", "menu",
    "search-form", "sharedaddy", "cookie-notice", "adsbygoogle", "advertisement", "social-navigation",
))
NOISE_PARTS = ("advert", "tracking", "analytics", "cookie", "share", "social")
_CONTENT_CLASSES = ("entry-content", "post-content", "content")
_SKIP_TITLES = frozenset(("search", "menu", "browse"))
# The words that a label consists of, with one more word.
_LABEL = re.compile(r"(?:(?:article|chapter|section)\s+\w+|(?:المادة|الفصل|الباب)\s+\S+)", re.I)
LABEL_CHARS = 90
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_INLINE = frozenset(("a", "b", "i", "em", "strong", "span", "u", "sup", "sub", "font", "code", "small", "label"))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs=(), parent=None):
        self.tag, self.attrs, self.parent = tag, dict(attrs), parent
        self.children: list = []

    def walk(self):
        """Depth first, without recursion, so depth has no limit."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        parts, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in ("script", "style"):
                stack += reversed(node.children)
        return " ".join(" ".join(parts).split())

    def short_text(self, most: int) -> str:
        """The text if it has at most ``most`` characters, else empty; stops looking when it has more."""
        parts, length, stack = [], 0, [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if word := " ".join(node.split()):
                    parts.append(word)
                    length += len(word) + 1
                    if length > 2 * most:
                        return ""
            elif node.tag not in ("script", "style"):
                stack += reversed(node.children)
        text = " ".join(parts)
        return text if len(text) <= most else ""

    def within(self, tag: str) -> bool:
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node is not None

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").lower().split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("root")

    def handle_starttag(self, tag, attrs):
        closes = _CLOSES.get(tag, set())
        if closes:
            node = self.at
            while node.parent and node.tag not in ("table", "ul", "ol", "div", "body"):
                if node.tag in closes:
                    self.at = node.parent
                    break
                node = node.parent
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def title_of(root: Node) -> str | None:
    """First heading (a marked or enclosed one before others), else a meta title, else ``title``."""
    for level in ("h1", "h2"):
        found = [n for n in root.walk() if n.tag == level]
        for pick in (lambda n: "entry-title" in n.classes(), lambda n: n.within("article"), lambda n: n.within("main"), lambda n: True):
            first = next((n for n in found if pick(n)), None)
            if first and (text := first.text()) and text.lower() not in _SKIP_TITLES:
                return text
    for key, value in (("property", "og:title"), ("name", "twitter:title"), ("name", "title")):
        for n in root.walk():
            if n.tag == "meta" and n.attrs.get(key) == value and (n.attrs.get("content") or "").strip():
                return " ".join(n.attrs["content"].split())
    return next((n.text() for n in root.walk() if n.tag == "title" and n.text()), None)


def links_of(root: Node, base: str) -> list[tuple[str, str]]:
    """(absolute URL, text) of every anchor with an address, in order."""
    out = []
    for n in root.walk():
        if n.tag == "a" and n.attrs.get("href"):
            try:
                out.append((urljoin(base or "", n.attrs["href"]), n.text()))
            except ValueError:
                continue
    return out


def is_noise(node: Node) -> bool:
    names = node.classes() + [(node.attrs.get("id") or "").lower()]
    return node.tag in NOISE_TAGS or any(c in NOISE_CLASSES for c in names) or any(p in c for c in names for p in NOISE_PARTS)


def drop_noise(root: Node) -> None:
    for node in list(root.walk()):
        node.children = [c for c in node.children if isinstance(c, str) or c.tag == "body" or not is_noise(c)]


def main_content(root: Node) -> Node:
    """The content container: article before main before marked classes before the body."""
    nodes = list(root.walk())
    for outer in ("article", "main"):
        for node in (n for n in nodes if n.tag == outer):
            inner = next((n for n in node.walk() if any(c in _CONTENT_CLASSES[:2] for c in n.classes()) and n.text()), None)
            if inner or node.text():
                return inner or node
    for name in _CONTENT_CLASSES:
        if found := next((n for n in nodes if (name in n.classes() or name == n.attrs.get("id")) and n.text()), None):
            return found
    return next((n for n in nodes if n.tag == "body"), root)


def table_markdown(table: Node) -> str:
    """A pipe table: the first row is the header, spans and ragged rows are padded."""
    rows = []
    for tr in (n for n in table.walk() if n.tag == "tr"):
        cells = []
        for c in tr.children:
            if isinstance(c, Node) and c.tag in ("td", "th"):
                span = c.attrs.get("colspan") or "1"
                cells += [c.text().replace("|", "\\|")] + [""] * (min(int(span), 1000) - 1 if span.isdigit() and int(span) > 0 else 0)
        if cells:
            rows.append(cells)
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]])


def _marked(node: Node, text: str, base: str) -> str:
    """The Markdown of an inline element around its text."""
    if node.tag == "a" and node.attrs.get("href") and text.strip():
        try:
            return f"[{' '.join(text.split())}]({urljoin(base or '', node.attrs['href'])})"
        except ValueError:
            return text
    if node.tag in ("b", "strong") and text.strip():
        return f"**{text.strip()}**"
    if node.tag in ("i", "em") and text.strip():
        return f"*{text.strip()}*"
    return text


def _inline(node: Node | str, base: str) -> str:
    """The text of a node with its inline marks; nesting of any depth."""
    parts: list[str] = []
    todo: list[tuple[Node | str, int | None]] = [(node, None)]
    while todo:
        n, begun = todo.pop()
        if begun is not None:
            parts[begun:] = [_marked(n, "".join(parts[begun:]), base)]
        elif isinstance(n, str):
            parts.append(n)
        elif n.tag == "br":
            parts.append("\n")
        else:
            if n.tag in ("a", "b", "strong", "i", "em"):
                todo.append((n, len(parts)))
            todo += [(c, None) for c in reversed(n.children)]
    return "".join(parts)


def _list_markdown(node: Node, base: str) -> str:
    items = (" ".join(_inline(li, base).split()) for li in node.children if isinstance(li, Node) and li.tag == "li")
    return "\n".join(f"{f'{i}.' if node.tag == 'ol' else '-'} {t}" for i, t in enumerate(filter(None, items), 1))


def is_label(text: str) -> bool:
    """Whether a text is nothing but the label of an article, chapter or section."""
    return len(text) <= LABEL_CHARS and _LABEL.fullmatch(text) is not None


def _block(node: Node, base: str) -> str | None:
    """The Markdown of a node that is one block, or None if its children are blocks of their own."""
    if node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        text = node.text()
        return "#" * int(node.tag[1]) + " " + text if text else ""
    if node.tag == "table" and not any(n.tag in ("p", "div", "h1", "h2", "ul", "ol") for n in node.walk()):
        return table_markdown(node)
    if node.tag in ("ul", "ol"):
        return _list_markdown(node, base)
    if node.tag in ("p", "div") and is_label(text := node.short_text(LABEL_CHARS)):
        return "### " + text
    return None


def blocks_of(root: Node, base: str) -> list[str]:
    """The Markdown blocks below a node, in order; nesting of any depth."""
    out: list[str] = []
    line: list[str] = []

    def close():
        text = re.sub(r"[ \t]+", " ", "".join(line)).strip()
        if text:
            out.append(re.sub(r"\s*\n\s*", "\n", text))
        line.clear()

    todo: list[Node | str | None] = [None, *reversed(root.children)]
    while todo:
        n = todo.pop()
        if n is None:
            close()
        elif isinstance(n, str) or n.tag in _INLINE or n.tag == "br":
            line.append(_inline(n, base))
        else:
            close()
            block = _block(n, base)
            if block is None:
                todo += [None, *reversed(n.children)]
            elif block:
                out.append(block)
    return out


def tidy_markdown(text: str) -> str:
    """Line ends and blank lines in order, one line break at the end; empty stays empty."""
    text = text.replace("\r\n", "\n").replace("\r", "\n").replace("\u00a0", " ")
    text = "\n".join(line.rstrip() for line in text.split("\n"))
    text = re.sub(r"\n{3,}", "\n\n", text).strip()
    return text + "\n" if text else ""


def markdown_of(root: Node, base: str, title: str | None = None) -> tuple[str | None, str]:
    """(title, Markdown) of a parsed page: noise removed (from ``root`` too), headings, lists and tables kept.

    A first heading is added if there is none.
    """
    title = title or title_of(root)
    drop_noise(root)
    text = tidy_markdown("\n\n".join(blocks_of(main_content(root), base)))
    if title and not text.startswith("#"):
        text = tidy_markdown(f"# {title}\n\n{text}")
    return title, text


def parse_pages(pages: DataFrame) -> DataFrame:
    """(page_id, title, markdown, links) of pages (page_id, source_url, content_html); null HTML gives empty results."""
    def convert(batches):
        for pdf in batches:
            rows = []
            for key, url, html in zip(pdf["page_id"], pdf["source_url"], pdf["content_html"]):
                root = parse(html or "")
                links = links_of(root, url or "")
                rows.append((key, *markdown_of(root, url or ""), links))
            yield pd.DataFrame(rows, columns=["page_id", "title", "markdown", "links"])

    return pages.select("page_id", "source_url", "content_html").mapInPandas(
        convert, "page_id long, title string, markdown string, links array<struct<url:string,text:string>>"
    )

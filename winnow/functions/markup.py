"""Page rules that need the element tree, as Arrow column functions.

Each function maps a batch of pages to a batch of results; Spark splits and moves the
pages.  The tree is flat (a list in document order), so depth of nesting costs no stack.
"""

from __future__ import annotations

import html as entities
import re
from html.parser import HTMLParser
from itertools import islice
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import functions as F

SPACES = re.compile(r"\s+")
LIST_INDENT = re.compile(r" +(?=(?:\*|\d+\.) )")

# --- fixed values: element and style lists that decide results ----------------
ALLOWED = [
    "a", "img", "h1", "h2", "h3", "h4", "h5", "h6", "title", "li", "ol", "ul", "pre", "code",
    "table", "tbody", "thead", "tfoot", "td", "th", "tr", "u", "s", "del", "b", "strong",
    "em", "i", "br", "hr", "blockquote", "q", "p", "div",
]
TEXTLESS = ["img", "br", "hr"]
DESTROYED = ["style", "script", "meta", "link"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
LINK_ATTRIBUTES = ["href", "title"]
IMAGE_ATTRIBUTES = ["href", "src", "width", "height", "alt", "title"]
TEXT_STYLES = [
    "font", "font-style", "font-weight", "font-size", "font-variant", "text-decoration",
    "text-decoration-line", "text-decoration-color", "text-decoration-style",
    "text-decoration-thickness", "text-transform", "color", "background-color",
]
VOID = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
]
# ------------------------------------------------------------------------------


class Element:
    """A tree node.  ``fate`` marks removal; lists of children are never edited."""

    __slots__ = ("name", "attrs", "kids", "parent", "fate", "ink")

    def __init__(self, name, attrs, parent):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.kids, self.fate, self.ink = [], None, 0

    def live_kids(self):
        stack = list(reversed(self.kids))
        while stack:
            kid = stack.pop()
            if isinstance(kid, str) or kid.fate is None:
                yield kid
            elif kid.fate == "unwrap":
                stack.extend(reversed(kid.kids))

    def live_parent(self):
        node = self.parent
        while node.fate == "unwrap":
            node = node.parent
        return node

    def lone_string(self):
        node = self
        while isinstance(node, Element):
            pair = list(islice(node.live_kids(), 2))
            if len(pair) != 1:
                return None
            node = pair[0]
        return node

    def strings(self):
        """Text nodes below, in order, without script and style content."""
        stack = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif node.name not in ("script", "style"):
                stack.extend(reversed(node.kids))


class Tree(HTMLParser):
    """Elements in document order; unclosed ones stay open, comments are not kept."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Element("", {}, None)
        self.elements = []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        first = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        node = Element(tag, first, self.open)
        self.open.kids.append(node)
        self.elements.append(node)
        if tag not in VOID:
            self.open = node

    def handle_endtag(self, tag):
        node = self.open
        while node.parent is not None and node.name != tag:
            node = node.parent
        if node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        kids = self.open.kids
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)

    def named(self, *names):
        return [e for e in self.elements if e.name in names and e.fate is None]

    def add_title_heading(self):
        title, body = self.named("title")[:1], self.named("body")[:1]
        if title and body:
            heading = Element("h1", {}, body[0])
            strong = Element("strong", {}, heading)
            strong.kids.append(" ".join(title[0].strings()).strip())
            heading.kids.append(strong)
            body[0].kids.insert(0, heading)
            at = self.elements.index(body[0]) + 1
            self.elements[at:at] = [heading, strong]

    def weigh(self):
        """Number of visible non-space characters at or below every element."""
        for node in reversed(self.elements):
            if node.name not in ("script", "style"):
                node.ink += sum(
                    len("".join(kid.split())) for kid in node.kids if isinstance(kid, str)
                )
                node.parent.ink += node.ink


def _kept_attributes(node):
    if node.name in ("a", "img"):
        names = LINK_ATTRIBUTES if node.name == "a" else IMAGE_ATTRIBUTES
        return {k: v for k, v in node.attrs.items() if k in names}
    styles = [s.strip() for s in node.attrs.get("style", "").split(";")]
    kept = ";".join(s for s in styles if s.split(":")[0] in TEXT_STYLES)
    return {"style": kept} if kept else {}


def _serialize(root):
    out, stack = [], list(root.live_kids())[::-1]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            out.append(node[0])
        elif isinstance(node, str):
            out.append(entities.escape(node, quote=False))
        else:
            attrs = "".join(f' {k}="{entities.escape(v)}"' for k, v in node.attrs.items())
            if node.name in VOID:
                out.append(f"<{node.name}{attrs}/>")
            else:
                out.append(f"<{node.name}{attrs}>")
                stack.append((f"</{node.name}>",))
                stack.extend(list(node.live_kids())[::-1])
    return "".join(out)


def reduced_html(page, url, text_only=True, title_in_body=True):
    """Page cut down to text markup."""
    if not page:
        return ""
    tree = Tree(page)
    if title_in_body:
        tree.add_title_heading()
    for node in tree.elements:
        for name in ("href", "src"):
            if url and name in node.attrs:
                node.attrs[name] = _joined(url, node.attrs[name])
        if node.name in HEADINGS or node.name == "title":
            node.kids = [k.strip() if isinstance(k, str) else k for k in node.kids]
    tree.weigh()
    for node in tree.elements:
        inkless = node.ink == 0 and node.name not in TEXTLESS
        if node.parent.fate == "drop" or node.name in DESTROYED or inkless:
            node.fate = "drop"
        elif node.name not in ALLOWED and not node.lone_string():
            node.fate = "unwrap"
        node.attrs = _kept_attributes(node)
    for node in tree.named("div", "p", "span"):
        above = node.live_parent()
        same = above.attrs == node.attrs if node.name == "span" else above.ink == node.ink
        if above.name == node.name and same:
            node.fate = "unwrap"
    for node in tree.named("img", "a"):
        web = node.attrs.get("href", "").startswith("http")
        if text_only or (node.name == "a" and not web):
            node.fate = "unwrap"
    return _serialize(tree.root)


def _joined(url, link):
    try:
        return urljoin(url, link.strip())
    except ValueError:
        return link


def markdown(page, url, text_only=True, title_in_body=True):
    """Page as Markdown with one line per block."""
    if not page:
        return ""
    tree = Tree(page)
    if title_in_body:
        tree.add_title_heading()
    out, lists, stack = [], [], [tree.root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            out.append(node[0])
            if node[1]:
                lists.pop()
            continue
        if isinstance(node, str):
            out.append(SPACES.sub(" ", node))
            continue
        before, after, in_list = "", "", False
        name = node.name
        if name in ("head", "script", "style", "title"):
            continue
        if name in HEADINGS:
            before, after = "\n\n" + "#" * int(name[1]) + " ", "\n\n"
        elif name in ("b", "strong"):
            before = after = "**"
        elif name in ("i", "em", "u"):
            before = after = "_"
        elif name in ("s", "del"):
            before = after = "~~"
        elif name == "code":
            before = after = "`"
        elif name == "br":
            before = "  \n"
        elif name == "hr":
            before = "\n\n* * *\n\n"
        elif name == "blockquote":
            before, after = "\n\n> ", "\n\n"
        elif name in ("ul", "ol"):
            lists.append([name, 0])
            before, after, in_list = "\n\n", "\n\n", True
        elif name == "li":
            mark = "* "
            if lists:
                lists[-1][1] += 1
                mark = "* " if lists[-1][0] == "ul" else f"{lists[-1][1]}. "
            before, after = "\n" + "  " * max(len(lists), 1) + mark, ""
        elif name in ("p", "div", "table", "pre", "article", "section"):
            before = after = "\n\n"
        elif name == "tr":
            before = "\n"
        elif name in ("td", "th"):
            after = " | "
        elif name == "a" and not text_only and node.attrs.get("href"):
            before, after = "[", f"]({_joined(url or '', node.attrs['href'])})"
        elif name == "img" and not text_only and node.attrs.get("src"):
            alt, src = node.attrs.get("alt", ""), _joined(url or "", node.attrs["src"])
            before = f"![{alt}]({src})"
        out.append(before)
        stack.append((after, in_list))
        stack.extend(reversed(node.kids))
    return _tidy_markdown("".join(out))


def _tidy_markdown(text):
    """One blank between words, one empty line between blocks, list indents kept."""
    lines = []
    for raw in text.split("\n"):
        indent = LIST_INDENT.match(raw)
        line = (indent.group(0) if indent else "") + " ".join(raw.split())
        if line or (lines and lines[-1]):
            lines.append(line)
    return "\n".join(lines).strip("\n")


def _page_udf(convert, text_only, title_in_body):
    @F.arrow_udf("string")
    def run(pages: pa.Array, urls: pa.Array) -> pa.Array:
        return pa.array(
            [
                convert(page, url, text_only, title_in_body)
                for page, url in zip(pages.to_pylist(), urls.to_pylist())
            ],
            pa.string(),
        )

    return run


def markdown_udf(text_only: bool = True, title_in_body: bool = True):
    return _page_udf(markdown, text_only, title_in_body)


def reduced_udf(text_only: bool = True, title_in_body: bool = True):
    return _page_udf(reduced_html, text_only, title_in_body)

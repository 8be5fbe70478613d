"""Small HTML helpers run inside Spark tasks: a node tree, class selectors and
article text.  Everything that can be an expression lives elsewhere."""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIPPED = {"script", "style", "head", "noscript", "template", "img"}
HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}
BLOCKS = {"p", "div", "section", "article", "ul", "ol", "table", "blockquote", "pre", "figure", "header", "footer", "nav", "body"}
MARKS = {"b": "**", "strong": "**", "em": "_", "i": "_", "code": "`"}


class Node:
    __slots__ = ("tag", "classes", "attrs", "children", "parent")

    def __init__(self, tag, attrs=(), parent=None):
        self.tag = tag
        self.attrs = {k: v or "" for k, v in attrs}
        self.classes = self.attrs.get("class", "").split()
        self.children = []
        self.parent = parent


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        # Paragraphs and list items end where the next one starts.
        if tag == self.at.tag and tag in ("p", "li", "td", "th", "tr"):
            self.at = self.at.parent
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def walk(node: Node):
    """All nodes below ``node`` in document order."""
    stack = [c for c in reversed(node.children) if isinstance(c, Node)]
    while stack:
        at = stack.pop()
        yield at
        stack.extend(c for c in reversed(at.children) if isinstance(c, Node))


def select_all(node: Node, selector: str):
    """Nodes for ``tag``, ``tag.class``, or ``tag[class text]``: the last form
    needs every listed class."""
    match = re.match(r"^(\w+)(?:\.([\w-]+)|\[([^\]]+)\])?$", selector)
    tag, one, several = match.groups()
    wanted = [one] if one else (several or "").split()
    return [n for n in walk(node) if n.tag == tag and all(c in n.classes for c in wanted)]


def select(node: Node, selectors) -> Node | None:
    for selector in selectors:
        found = select_all(node, selector)
        if found:
            return found[0]
    return None


def drop(node: Node, selectors) -> None:
    for selector in selectors:
        for found in select_all(node, selector):
            if found in found.parent.children:
                found.parent.children.remove(found)


def inner_text(node: Node | None) -> str:
    """Stripped pieces of text, joined without a separator."""
    if node is None:
        return ""
    pieces, stack = [], list(reversed(node.children))
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            pieces.append(at.strip())
        else:
            stack.extend(reversed(at.children))
    return "".join(pieces)


def _inline(text: str) -> str:
    return re.sub(r"\s+", " ", text)


def to_markdown(node: Node) -> str:
    """Markdown of a subtree: headings, lists, tables, emphasis, code; the text
    of links; no images."""
    out: list[str] = []

    def block():
        out.append("\n\n")

    def close(tag):
        if tag in HEADINGS or tag in BLOCKS:
            block()
        elif tag in MARKS:
            out.append(MARKS[tag])

    # Explicit stack: deep pages must not exhaust the call stack.
    stack: list = [("open", node, False)]
    while stack:
        step, at, in_pre = stack.pop()
        if step == "close":
            if at.tag == "pre":
                out.append("\n```")
            close(at.tag)
            if at.tag == "tr":
                out.append("\n")
                cells = [c for c in at.children if isinstance(c, Node) and c.tag in ("td", "th")]
                if cells and all(c.tag == "th" for c in cells):
                    out.append("|".join(["---"] * len(cells)) + "\n")
            continue
        if isinstance(at, str):
            out.append(at if in_pre else _inline(at))
            continue
        if at.tag in SKIPPED:
            continue
        pre = in_pre or at.tag == "pre"
        if at.tag in HEADINGS:
            block()
            out.append(HEADINGS[at.tag])
        elif at.tag == "pre":
            block()
            out.append("```\n")
        elif at.tag == "li":
            out.append("\n  * ")
        elif at.tag == "br":
            out.append("  \n")
        elif at.tag == "hr":
            out.append("\n\n* * *\n\n")
        elif at.tag in ("td", "th"):
            cells = [c for c in at.parent.children if isinstance(c, Node) and c.tag in ("td", "th")]
            if cells and cells[0] is not at:
                out.append(" | ")
        elif at.tag in BLOCKS:
            block()
        elif at.tag in MARKS and not in_pre:
            out.append(MARKS[at.tag])
        if at.tag in VOID:
            continue
        stack.append(("close", at, in_pre))
        stack.extend(("open", c, pre) for c in reversed(at.children))
    text = "".join(out)
    text = re.sub(r"[ \t]+\n", "\n", text)
    text = re.sub(r"\n[ \t]+(?![ *])", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n") + "\n\n"

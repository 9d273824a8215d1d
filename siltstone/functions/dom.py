"""A small element tree over the standard library's parser, for the few pages that need one."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "p": {"p"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NAMED = re.compile(r"&(?=([A-Za-z][A-Za-z0-9]*)(;?))")


class Node:
    """An element: tag, attributes, and children that are nodes or text."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def has(self, tag: str | None = None, *classes: str, **attrs: str) -> bool:
        own = self.attrs.get("class", "").split()
        return (tag is None or self.tag == tag) and all(c in own for c in classes) and all(self.attrs.get(k) == v for k, v in attrs.items())

    def all(self, tag: str | None = None, *classes: str, **attrs: str) -> list[Node]:
        return [n for n in self.walk() if n.has(tag, *classes, **attrs)]

    def first(self, tag: str | None = None, *classes: str, **attrs: str) -> Node | None:
        return next((n for n in self.walk() if n.has(tag, *classes, **attrs)), None)

    def outermost(self, *tags: str) -> Iterator[Node]:
        """The elements of these tags that stand in no other of them, in page order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            if node.tag in tags:
                yield node
            else:
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in ("script", "style"):
                stack += reversed(item.children)

    def text(self, between: str = "", strip: bool = False) -> str:
        parts = (s.strip() for s in self.strings()) if strip else self.strings()
        return between.join(p for p in parts if p or not strip)

    def within(self, tag: str | None = None, *classes: str) -> bool:
        node = self.parent
        while node is not None:
            if node.has(tag, *classes):
                return True
            node = node.parent
        return False

    def html(self) -> str:
        attrs = "".join(f' {k}="{v}"' for k, v in self.attrs.items())
        inner = "".join(c if isinstance(c, str) else c.html() for c in self.children)
        return f"<{self.tag}{attrs}/>" if self.tag in VOID else f"<{self.tag}{attrs}>{inner}</{self.tag}>"


class Builder(HTMLParser):
    """``stand_in`` is a character that is read as '&' once references are decoded."""

    def __init__(self, stand_in: str = "&") -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.stand_in = stand_in

    def node(self, tag: str, attrs: list) -> Node:
        return Node(tag, {k.replace(self.stand_in, "&"): (v or "").replace(self.stand_in, "&") for k, v in attrs}, self.at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.at.tag in CLOSED_BY and tag in CLOSED_BY.get(self.at.tag, ()):
            self.at = self.at.parent or self.root
        node = self.node(tag, attrs)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(self.node(tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data.replace(self.stand_in, "&"))


def parse(html: str | None, cut_names: bool = True) -> Node:
    """The tree of a page. ``cut_names``: names of references that lack their semicolon ('&amp' at a text's end) are decoded too, else they stay as they stand."""
    html, stand_in = html or "", "&"
    if not cut_names:
        whole = lambda m: m[2] and f"{m[1]};" in html5
        if any(not whole(m) for m in NAMED.finditer(html)):
            stand_in = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in html)
            html = NAMED.sub(lambda m: "&" if whole(m) else stand_in, html)
    builder = Builder(stand_in)
    builder.feed(html)
    builder.close()
    return builder.root


def scripts(root: Node, kind: str) -> list[str]:
    return ["".join(c for c in n.children if isinstance(c, str)) for n in root.all("script", type=kind)]


def number_in(text: str | None) -> int | None:
    m = re.search(r"\d+", text or "")
    return int(m[0]) if m else None

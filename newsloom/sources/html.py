"""A small tree over the standard library's tolerant html parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack: list[Node] = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find_all(self, *tags: str, cls: str | None = None, **attrs: str | None) -> Iterator[Node]:
        """Nodes below with one of the tags, the class, and the attributes (null: any value)."""
        for n in self.walk():
            if n is self or (tags and n.tag not in tags) or (cls and cls not in n.attrs.get("class", "").split()):
                continue
            names = {k.rstrip("_").replace("_", "-"): v for k, v in attrs.items()}
            if all(k in n.attrs and (v is None or n.attrs[k] == v) for k, v in names.items()):
                yield n

    def find(self, *tags: str, cls: str | None = None, **attrs: str | None) -> Node | None:
        return next(self.find_all(*tags, cls=cls, **attrs), None)

    def text(self) -> str:
        """All text below, pieces trimmed and joined by one space."""
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    out.append(" ".join(n.split()))
            else:
                stack.extend(reversed(n.children))
        return " ".join(out)

    def raw(self) -> str:
        return "".join(c for c in self.children if isinstance(c, str))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(n)
        if tag not in _VOID:
            self.at = n

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        n: Node | None = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(text: str | None) -> Node:
    """The tree of a page; broken markup never raises."""
    b = _Builder()
    b.feed(text or "")
    b.close()
    return b.root

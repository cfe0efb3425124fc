"""A small element tree for saved pages, on the standard library parser (helper of K3-K5)."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from xml.etree.ElementTree import Element, TreeBuilder

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SKIPPED = {"script", "style"}
_STEP = re.compile(r"([a-z][a-z0-9]*)?((?:[.#][\w-]+)*)", re.I)


class _Tree(HTMLParser):
    """Builds elements; an end tag closes up to its start tag, a stray end tag is ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.builder = TreeBuilder()
        self.builder.start("root", {})
        self.open: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.builder.start(tag, {k: v or "" for k, v in attrs})
        if tag in _VOID:
            self.builder.end(tag)
        else:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.builder.start(tag, {k: v or "" for k, v in attrs})
        self.builder.end(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open:
                last = self.open.pop()
                self.builder.end(last)
                if last == tag:
                    break

    def handle_data(self, data):
        self.builder.data(data)


def parse(html: str) -> Element:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    while tree.open:
        tree.builder.end(tree.open.pop())
    tree.builder.end("root")
    return tree.builder.close()


def _matches(element: Element, step: str) -> bool:
    tag, marks = _STEP.fullmatch(step).groups()
    if tag and element.tag != tag:
        return False
    classes = element.get("class", "").split()
    return all(
        mark[1:] in classes if mark[0] == "." else element.get("id") == mark[1:]
        for mark in re.findall(r"[.#][\w-]+", marks or "")
    )


def select(element: Element, path: str) -> list[Element]:
    """Descendants along a path of ``tag.class#id`` steps, in document order."""
    found = [element]
    for step in path.split():
        nested = [e for parent in found for e in parent.iter() if e is not parent and _matches(e, step)]
        found = list({id(e): e for e in nested}.values())
    return found


def text_of(element: Element) -> str:
    """All text inside an element but scripts and styles; pages may nest deeply, so no recursion."""
    parts, stack = [], [element]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag not in _SKIPPED:
            parts.append(item.text or "")
            for child in reversed(item):
                stack += [child.tail or "", child]
    return "".join(parts)

"""A small tree of a web page, and the selectors that listing recipes use."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASCII_SPACE = re.compile(r"[\t\n\f\r ]+")
_CLOSED_BY = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_LIMIT = frozenset("table ul ol dl select div article section nav header footer body".split())


@dataclass(eq=False)
class Element:
    tag: str
    attrs: dict[str, str]
    parent: Element | None
    children: list[Element | str] = field(default_factory=list)

    def ancestors(self) -> Iterator[Element]:
        e = self.parent
        while e is not None:
            yield e
            e = e.parent

    def walk(self) -> Iterator[Element]:
        stack = [self]
        while stack:
            e = stack.pop()
            yield e
            stack += [c for c in reversed(e.children) if isinstance(c, Element)]

    def text(self, skip: frozenset[str] = frozenset(), space: re.Pattern[str] | None = None) -> str:
        """What is in it, with runs of white space (of ``space``, if given) as one space."""
        parts: list[str] = []
        stack: list[Element | str] = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x)
            elif x.tag not in skip:
                stack += reversed(x.children)
        whole = " ".join(parts)
        return space.sub(" ", whole).strip(" ") if space else " ".join(whole.split())

    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#page", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        e: Element | None = self.at
        while tag in _CLOSED_BY and e is not None and e.tag not in _LIMIT:
            if e.tag in _CLOSED_BY[tag]:
                self.at = e.parent or self.root
            e = e.parent
        new = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(new)
        if tag not in VOID:
            self.at = new

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for e in (self.at, *self.at.ancestors()):
            if e.tag == tag:
                self.at = e.parent or self.root
                return

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


_SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[\w-]+(?:[*^$]?=[^\]]*)?\])*)$")


def _fits(e: Element, simple: str) -> bool:
    m = _SIMPLE.match(simple)
    if not m:
        raise ValueError(f"unknown selector: {simple}")
    if m[1] and m[1] not in ("*", e.tag):
        return False
    for part in re.findall(r"[.#][\w-]+|\[[^\]]+\]", m[2]):
        if part[0] == "." and part[1:] not in e.classes() or part[0] == "#" and e.attrs.get("id") != part[1:]:
            return False
        if part[0] == "[":
            name, op, value = re.match(r"\[([\w-]+)(?:([*^$]?=)[\"']?([^\"'\]]*)[\"']?)?\]", part).groups()
            have = e.attrs.get(name)
            if have is None or op and not {"=": have == value, "*=": value in have, "^=": have.startswith(value), "$=": have.endswith(value)}[op]:
                return False
    return True


def select(root: Element, selector: str) -> list[Element]:
    """Elements below ``root`` in page order: tags, classes, ids and attributes, descendants, alternatives by comma."""
    chains = [alternative.split() for alternative in selector.split(",")]

    def found(e: Element) -> bool:
        for chain in chains:
            if not _fits(e, chain[-1]):
                continue
            rest = chain[:-1]
            for a in e.ancestors():
                if rest and _fits(a, rest[-1]):
                    rest = rest[:-1]
            if not rest:
                return True
        return False

    return [e for e in root.walk() if e is not root and found(e)]

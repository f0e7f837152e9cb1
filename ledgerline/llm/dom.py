"""HTML into a tree of blocks, tolerant of missing and crossed tags.

Only block elements are nodes. Inline elements give their text to the block around them; a text run between the blocks
of an element is a node of its own, ``#text``. Scripts, styles and the like, comments and what belongs in a head have no
text. A head needs no end: its elements are silent or empty, and whatever else comes belongs to the body. Of a silent
element without an end tag only the start tag is skipped, unless its content is raw text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

_TOKEN = re.compile(r"<(?:!--(?:.*?--!?>|.*)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|$)))", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_BODY = re.compile(r"</head\s*>|<body\b", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none")
# Elements by how a browser lays them out.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul label select option optgroup button".split())
SILENT = frozenset("script style noscript template iframe object svg math title textarea canvas audio video noembed noframes xmp".split())
RAW = frozenset("script style xmp noembed noframes".split())  # tags in them are text: without an end tag, all the rest is theirs
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in SILENT}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening element ends the open ones to the right of it, up to one of the last set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
INSIDE_P = frozenset("label button select option optgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SHORT = 300  # characters of attributes that are worth remembering


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    attrs: str = ""
    mark: str = ""  # of labelled pages only
    text: Sequence[str] = ()
    links: int = 0
    linked: int = 0  # characters in links
    controls: int = 0


def _attributes(rest: str) -> tuple[str, str]:
    """The values that name an element, and its mark."""
    kept, mark = [], ""
    for a in _ATTRIBUTE.finditer(rest):
        name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            kept.append(value)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
            kept.append("hidden")
        elif name == "data-mark":
            mark = value
    return " ".join(kept), mark


_remembered = lru_cache(maxsize=4096)(_attributes)


def parse(html: str | None) -> list[Node]:
    """Nodes in page order, so that a block is followed by all that is in it; the first is the page itself. A block whose
    only content is one run of text holds the text itself."""
    html = html or ""
    nodes = [Node("#page", -1)]
    stack, tags = [0], ["#page"]  # the open elements
    run: list[str] = []  # text since the last block tag
    run_marks: dict[int, str] = {}  # of blocks that hold text themselves
    in_link = False
    unclosed: set[str] = set()  # silent elements that have no end tag from here on

    def add(tag: str, attrs: str = "", mark: str = "") -> Node:
        at = stack[-1]
        top = nodes[at]
        if top.text:  # not its only content
            nodes.append(Node("#text", at, "", run_marks.pop(at, ""), top.text, 0, top.linked))
            top.text, top.linked = (), 0
        node = Node(tag, at, attrs, mark)
        nodes.append(node)
        return node

    def settle() -> None:
        text = run[0] if len(run) == 1 else "".join(run)
        run.clear()
        text = " ".join((unescape(text) if "&" in text else text).split())
        if not text:
            return
        at = stack[-1]
        if at == len(nodes) - 1 and not nodes[at].text:  # its first content
            node = nodes[at]
            if run_mark:
                run_marks[at] = run_mark
        else:
            node = add("#text", mark=run_mark)
        node.text, node.linked = [text], min(linked, len(text))

    linked, run_mark = 0, ""
    position, end = 0, len(html)
    while position < end:
        jump = end
        for found in _TOKEN.finditer(html, position):
            start = found.start()
            if start > position:
                text = html[position:start]
                run.append(text)
                if in_link:
                    linked += len(text.strip())
            position = found.end()
            closing, tag, rest = found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if tag not in BLOCKS:
                if tag == "a":
                    in_link = not closing
                    if not closing:
                        nodes[stack[-1]].links += 1
                elif tag == "br":
                    run.append(" ")
                elif tag == "input":
                    nodes[stack[-1]].controls += 1
                elif tag in SILENT:
                    if not closing and not rest.rstrip(">").endswith("/"):
                        stop = None if tag in unclosed else _ENDS[tag].search(html, position)
                        body = None if stop and tag != "title" else _BODY.search(html, position, stop.start() if stop else end)
                        if body and (tag == "title" or tag in RAW):  # not ended in the head
                            jump = body.start()
                        elif stop:
                            jump = stop.end()
                        elif tag not in RAW:
                            unclosed.add(tag)
                            continue
                        position = jump
                        break
                elif tag == "span" and "data-mark" in rest:  # of labelled pages only
                    run_mark = next((a[2] or "" for a in _ATTRIBUTE.finditer(rest) if a[1] == "data-mark"), run_mark)
                continue
            if run:
                settle()
            linked, run_mark = 0, ""
            in_link = in_link and not closing and tag not in ("p", "li", "td")
            if closing:
                if tag in tags:
                    while tags.pop() != tag:
                        stack.pop()
                    stack.pop()
                continue
            if tag in CLOSES:
                ended, limit = CLOSES[tag]
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[depth] in ended:
                        del stack[depth:], tags[depth:]
                    elif tags[depth] in limit:
                        break
            elif tag not in INSIDE_P:
                if tags[-1] == "p" or (tag in HEADINGS and tags[-1] in HEADINGS):
                    stack.pop()
                    tags.pop()
            if tag in ("html", "body") and tag in tags:
                continue
            attrs, mark = ("", "") if len(rest) < 2 else _remembered(rest) if len(rest) <= SHORT else _attributes(rest)
            add(tag, attrs, mark)
            if tag not in VOID:
                stack.append(len(nodes) - 1)
                tags.append(tag)
        else:
            if position < end:
                text = html[position:]
                run.append(text)
                if in_link:
                    linked += len(text.strip())
            position = end
    if run:
        settle()
    for at, mark in run_marks.items():
        nodes[at].mark = mark
    return nodes

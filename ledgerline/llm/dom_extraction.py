"""Main text of web pages: gradient-boosted trees over the nodes of the page's tree, decoded from the root down.

Every block is a container of main text and other things, main text, or neither. The classifier's features are the
kind of element, the words of its attributes (hashed into TOKENS places, and by the groups of names that authors give to
regions; the groups also of what is above it), its depth, the size and density of its subtree (text, links, marks of
sentences, paragraphs, controls), its share of the page and of its parent, and its place among its siblings.
Decoding takes the most probable labelling of the whole tree in which nothing inside a dropped block is kept: a
container may hold anything, main text may hold main text or dropped blocks, a dropped block holds dropped blocks only.

The trees are trained on the driver on PAGES made-up pages whose blocks are labelled as they are written: menus,
headers, footers, sidebars, notices, adverts, forms, reader comments and articles, in semantic elements or in divs that
have names, with and without closing tags. Articles have paragraphs, or text runs beside blocks, in elements of their own or
straight in the body. No page of the input is learned from.

Defined cases: a null or empty page has the empty text; so has one without main text; pages are read one by one,
repeated or not; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .boosted_trees import Boosted
from .common import read
from .dom import Node, parse

PAGES, SEED = 1200, 11
AT_ONCE, LETTERS_AT_ONCE = 400, 4_000_000  # pages, and their characters; one page is never divided
STEP_WEIGHT = 0.5  # under 1, since a node's features tell of its surroundings already
CONTAINER, KEEP, DROP = 0, 1, 2

# Kinds of elements, and parts of names that authors give to regions of a page.
KINDS = ("#page html", "body", "article", "main", "section", "div center", "p", "h1", "h2 h3 h4 h5 h6", "ul ol menu dl dir", "li dd dt", "nav", "header hgroup", "footer address", "aside details dialog", "form fieldset search", "table tbody thead tfoot tr", "td th caption", "figure figcaption", "blockquote pre", "button label select option optgroup legend summary", "#text")
NAMES = (
    r"nav|menu|breadcrumb|crumb|pager|pagination|toolbar|tabs",
    r"header|masthead|topbar|branding|logo",
    r"foot|copyright|legal|imprint|colophon",
    r"side|aside|widget|rail\b|column-?right|column-?left",
    r"\bads?\b|advert|sponsor|promo|banner|outbrain|taboola|dfp",
    r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|toast|announcement|disclaimer|warning",
    r"share|social|follow|twitter|facebook",
    r"related|recommend|more-|read-?next|trending|popular|latest",
    r"comment|disqus|repl(?:y|ies)|respond|discussion|feedback|reviews",
    r"form|login|signin|signup|register|subscri|newsletter|search|contact",
    r"article|story",
    r"content|prose|maintext|bodytext|\btext\b",
    r"main|primary|page",
    r"post|entry|blog",
    r"hidden|sr-only|skip",
    r"meta|byline|author|date|tags?\b|categor",
)
_NAMES = [re.compile(n, re.I) for n in NAMES]
_KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags.split()}
_WORDS = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
TOKENS = 64  # places of hashed words of attributes, one bit each
CONTROLS = frozenset("button select label".split())
N_FEATURES = len(KINDS) + 3 * len(NAMES) + TOKENS + 24


@lru_cache(maxsize=4096)
def named(attrs: str) -> int:
    """A bit for each group of names."""
    spaced = _CAMEL.sub("-", attrs).replace("_", "-")
    return sum(1 << i for i, n in enumerate(_NAMES) if n.search(spaced)) if attrs else 0


@lru_cache(maxsize=4096)
def tokens(attrs: str) -> int:
    """A bit for each place that a word of an element's attributes has."""
    return sum(1 << i for i in {xxhash.xxh64_intdigest(w) % TOKENS for w in _WORDS.findall(_CAMEL.sub("-", attrs).lower())})


def _bits(numbers: np.ndarray, n: int) -> np.ndarray:
    """A row for each of the lowest n bits."""
    return np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :n].T


def features(*pages: list[Node]) -> np.ndarray:
    """A row for each node of each page. Nodes come in page order, so that what is in a block follows it without a gap:
    sums of a subtree are differences of running sums."""
    flat = [node for nodes in pages for node in nodes]
    n = len(flat)
    first = [at for at, nodes in zip(accumulate(map(len, pages), initial=0), pages, strict=False) for _ in nodes]
    parent = [at + node.parent if node.parent >= 0 else i for i, (at, node) in enumerate(zip(first, flat, strict=True))]  # a page is its own
    names = [named(node.attrs) for node in flat]
    depth, within, size = [0] * n, [0] * n, [1] * n
    for i, p in enumerate(parent):
        if p < i:
            depth[i] = depth[p] + 1
            within[i] = within[p] | names[i]
    for i in range(n - 1, 0, -1):
        if parent[i] < i:
            size[parent[i]] += size[i]
    tags = [node.tag for node in flat]
    texts = [node.text[0] if node.text else "" for node in flat]
    kind = np.array([_KIND.get(t, 5) for t in tags])
    numbers = {t: i for i, t in enumerate(set(tags))}
    root, over, every = np.array(first), np.array(parent), np.arange(n)

    own = np.array([len(t) for t in texts])
    of_node = np.stack([  # text, linked, links, sentence marks, paragraphs, leaves, controls, headings
        own, [node.linked for node in flat], [node.links for node in flat],
        [t.count(".") + t.count(",") + t.count(";") + t.count("!") + t.count("?") if t else 0 for t in texts],
        [t == "p" for t in tags], own > 0, [node.controls + (node.tag in CONTROLS) for node in flat], [t in ("h1", "h2", "h3") for t in tags],
    ])
    running = np.zeros((len(of_node), n + 1), np.int64)
    np.cumsum(of_node, axis=1, out=running[:, 1:])
    s = (running[:, every + np.array(size)] - running[:, :-1]).astype(float)  # of the subtree
    passed = np.cumsum(np.where([t == "#text" for t in tags], own, 2 * own))  # a block that holds its text itself counts as two
    order = np.concatenate([[0], passed[:-1]])
    order = order - order[root]

    below = np.flatnonzero(over < every)
    below = below[np.argsort(over[below], kind="stable")]  # by parent, in page order
    starts = np.concatenate([[True], over[below][1:] != over[below][:-1]])[: len(below)]
    along = np.arange(len(below))
    place, previous, alike, largest = np.zeros(n), np.full(n, -1), np.zeros(n), np.zeros(n)
    place[below] = along - np.maximum.accumulate(np.where(starts, along, 0))
    previous[below[1:]] = np.where(starts[1:], -1, kind[below[:-1]])
    _, which, times = np.unique(over[below] * len(numbers) + np.array([numbers[t] for t in tags])[below], return_inverse=True, return_counts=True)
    alike[below] = times[which]
    children = np.bincount(over[below], minlength=n)
    np.maximum.at(largest, over[below], s[0, below])

    out = np.zeros((N_FEATURES, n), np.float32)
    k, m = len(KINDS), len(NAMES)
    out[kind, every] = 1
    names = np.array(names)
    for at, bits in enumerate((names, np.array(within)[over], names[over])):
        out[k + at * m : k + (at + 1) * m] = _bits(bits, m)
    out[k + 3 * m : k + 3 * m + TOKENS] = _bits(np.array([tokens(node.attrs) for node in flat], "<u8"), TOKENS)
    text, total = np.maximum(1.0, s[0]), np.maximum(1.0, s[0, root])
    out[k + 3 * m + TOKENS :] = (
        depth, np.log1p(s[0]), np.log1p(own), s[1] / text, np.log1p(s[2]), 100 * s[3] / text, np.log1p(s[4]), np.log1p(s[5]),
        s[0] / np.maximum(1.0, s[5]), s[6], s[7], s[0] / total, s[0] / np.maximum(1.0, s[0, over]), largest / text, order / total, (order + s[0]) / total,
        place, children[over], alike, previous,
        kind[over], children, s[2] * 100 / text, ["©" in t for t in texts],
    )
    return out.T


def decode(nodes: list[Node], scores: np.ndarray, steps: np.ndarray) -> list[int]:
    """The labels of the most probable consistent labelling. scores: by node, log P(label | features); steps: what a
    label costs below another, the weighted log P(label of a block | label of the block that it is in). Page order
    puts parents first."""
    best = scores.tolist()  # of the subtree, by label of its root
    (cc, ck, cd), (_, kk, kd), (_, _, dd) = steps.tolist()
    choice = [(CONTAINER, DROP)] * len(nodes)  # below a container, below main text
    for i in range(len(nodes) - 1, 0, -1):
        container, keep, drop = best[i]
        above = best[nodes[i].parent]
        label, most = CONTAINER, container + cc
        if keep + ck > most:
            label, most = KEEP, keep + ck
        if drop + cd > most:
            label, most = DROP, drop + cd
        above[CONTAINER] += most
        if drop + kd > keep + kk:
            choice[i] = label, DROP
            above[KEEP] += drop + kd
        else:
            choice[i] = label, KEEP
            above[KEEP] += keep + kk
        above[DROP] += drop + dd
    labels = [best[0].index(max(best[0]))]
    for i in range(1, len(nodes)):
        above = labels[nodes[i].parent]
        labels.append(DROP if above == DROP else choice[i][above])
    return labels


def main_text(nodes: list[Node], labels: list[int]) -> str:
    return " ".join([t for node, label in zip(nodes, labels, strict=True) if label == KEEP for t in node.text])


# --- labelled pages -------------------------------------------------------------------------------------------------

_REGION_NAMES = {
    "nav": ("nav", "navbar", "main-menu", "topnav", "menu", "site-navigation", "breadcrumbs", "nav-links"),
    "header": ("header", "site-header", "masthead", "topbar", "page-header", "branding"),
    "footer": ("footer", "site-footer", "page-footer", "copyright", "legal", "foot"),
    "aside": ("sidebar", "side", "widget-area", "aside", "right-rail", "col-side", "widgets"),
    "ad": ("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner", "advertisement"),
    "notice": ("cookie-notice", "consent", "notice", "alert", "cookie-banner", "popup", "announcement", "gdpr"),
    "share": ("share", "social-links", "share-buttons", "follow-us"),
    "related": ("related", "related-posts", "recommended", "more-stories", "read-next", "trending"),
    "comments": ("comments", "comment-list", "reader-comments", "discussion", "disqus", "responses", "comments-area"),
    "form": ("newsletter", "login", "signup", "search-form", "subscribe", "contact-form"),
}
_CONTENT_NAMES = ("content", "article", "post", "entry", "story", "post-content", "entry-content", "article-body", "main-content", "text", "prose", "post-body", "c1", "x7", "box")
_WRAPPERS = ("page", "wrapper", "container", "site", "main", "layout", "row", "outer", "content-area", "")


class Writer:
    """Writes a labelled page. Marks are attributes that no feature reads."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.sloppy = self.r.random() < 0.4
        parts = ["".join(self.r.choice("bcdfghlmnprstvwz") * self.r.randint(0, 1) + self.r.choice("aeiouäéñ") for _ in range(self.r.randint(1, 3))) for _ in range(80)]
        self.vocabulary = ["".join(self.r.choices(parts, k=self.r.randint(1, 3))) for _ in range(300)]

    def words(self, low: int, high: int) -> str:
        return " ".join(self.r.choices(self.vocabulary, k=self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.r.randint(low, high)):
            s = self.words(1, 22).capitalize()
            if self.r.random() < 0.4:
                s = s.replace(" ", ", ", 1)
            out.append(s + self.r.choice("....?!"))
        text = " ".join(out)
        if self.r.random() < 0.15:
            text = re.sub(r" ", lambda m: self.r.choice([" ", "### ", "&amp;&amp; ", "%%% "]), text)
        elif self.r.random() < 0.05:
            text = text.replace(" ", " | ")
        elif self.r.random() < 0.05:
            text = text.upper().replace(".", "!!")
        elif self.r.random() < 0.05:
            text = " ".join(w for w in text.split(" ") for _ in range(self.r.randint(3, 12)))
        return text

    def name(self, choices: tuple[str, ...], often: float = 0.9) -> str:
        if self.r.random() > often:
            return ""
        c = self.r.choice(choices)
        return f' {self.r.choice(["class", "class", "id"])}="{c}"' if c else ""

    def tag(self, tag: str, inner: str, mark: int | None = None, attrs: str = "", close: bool = True) -> str:
        label = "" if mark is None else f' data-mark="{mark}"'
        return f"<{tag}{attrs}{label}>{inner}" + (f"</{tag}>" if close else "")

    def links(self, n: int) -> str:
        items = [self.tag("li", self.tag("a", self.words(1, 3), attrs=' href="/x"'), close=not self.sloppy) for _ in range(n)]
        if self.r.random() < 0.3:
            return " ".join(self.tag("a", self.words(1, 3), attrs=' href="/x"') for _ in range(n))
        return self.tag("ul", "".join(items))

    def region(self, kind: str) -> str:
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind)
        use = semantic and self.r.random() < 0.55
        tag = semantic if use else "div"
        attrs = self.name(_REGION_NAMES[kind], 0.35 if use and kind != "comments" else 0.97)
        r = self.r
        if kind == "nav":
            inner = self.links(r.randint(2, 9))
        elif kind == "header":
            inner = r.choice([self.tag("a", self.words(1, 3)), self.tag("h1", self.words(1, 3)), self.tag("p", self.words(2, 8))]) + (self.region("nav") if r.random() < 0.4 else "")
        elif kind == "footer":
            inner = r.choice(["&copy; ", "", "© 2024 "]) + r.choice([self.words(1, 4) + " &middot; " + self.sentences(1, 2), self.tag("p", self.sentences(1, 2)), self.links(r.randint(2, 6)) + self.tag("p", self.words(2, 8))])
        elif kind == "aside":
            inner = "".join(self.tag(r.choice(["h2", "h3", "h4"]), self.words(1, 4)) + r.choice([self.links(r.randint(2, 7)), self.tag("p", self.sentences(1, 3))]) for _ in range(r.randint(1, 3)))
        elif kind == "ad":
            inner = r.choice([self.sentences(1, 2), self.tag("p", self.sentences(1, 3)), self.tag("a", self.words(2, 8)), self.tag("span", self.words(1, 2)) + self.sentences(1, 1)])
        elif kind == "notice":
            inner = r.choice([self.sentences(1, 3), self.tag("p", self.sentences(1, 3))]) + (self.tag("button", self.words(1, 2)) if r.random() < 0.5 else "")
        elif kind == "share":
            inner = self.links(r.randint(2, 5))
        elif kind == "related":
            inner = self.tag("h3", self.words(1, 3)) + self.links(r.randint(2, 6))
        elif kind == "comments":
            one = lambda: self.tag(r.choice(["div", "article", "li"]), self.tag(r.choice(["b", "p", "cite"]), self.words(1, 2)) + self.tag("p", self.sentences(1, 4)), attrs=self.name(("comment", "reply", "comment-body", "response"), 0.6))
            inner = (self.tag(r.choice(["h2", "h3"]), self.words(1, 2)) if r.random() < 0.6 else "") + "".join(one() for _ in range(r.randint(1, 5)))
        else:
            inner = self.tag("label", self.words(1, 3)) + '<input type="text">' + self.tag("button", self.words(1, 2)) + (self.tag("p", self.sentences(1, 2)) if r.random() < 0.4 else "")
        return self.tag(tag, inner, DROP, attrs)

    def loose(self, low: int, high: int) -> str:
        """A text run of an article, in no block of its own; the mark is of the run."""
        bits = [self.sentences(1, 3) for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.3:
            bits[0] = self.r.choice(['<a href="/y">{}</a> ', "<em>{}</em> ", "<b>{}</b> "]).format(self.words(1, 3)) + bits[0]
        return self.tag("span", "", KEEP) + self.r.choice(["<br>", "<br><br>\n", "<br/>", " "]).join(bits)

    def mixed(self) -> str:
        """An element of an article with text runs beside blocks."""
        r = self.r
        short = lambda: self.tag("span", "", KEEP) + r.choice([self.words(1, 8), self.sentences(1, 2)])
        below = lambda tag, inner: self.tag(tag, inner, KEEP)
        items = lambda: below(r.choice(["ul", "ol"]), "".join(below("li", self.words(1, 8)) for _ in range(r.randint(1, 4))))
        x = r.random()
        if x < 0.3:
            return below("div", self.loose(1, 3) + r.choice([below(r.choice(["h2", "h3"]), self.words(1, 5)), below("p", self.sentences(1, 3)), items(), self.region("ad")]) + self.loose(1, 3))
        if x < 0.6:
            return below(r.choice(["ul", "ol"]), "".join(below("li", short() + (r.choice([items(), below("p", self.sentences(1, 2))]) if r.random() < 0.7 else "")) for _ in range(r.randint(1, 4))))
        if x < 0.8:
            cell = lambda: below("td", short() + (r.choice([below("p", self.sentences(1, 2)), items()]) if r.random() < 0.7 else "") + (short() if r.random() < 0.2 else ""))
            return below("table", "".join(below("tr", "".join(cell() for _ in range(r.randint(1, 3)))) for _ in range(r.randint(1, 3))))
        return below("blockquote", self.loose(1, 2) + below("p", self.sentences(1, 2)) + (self.loose(1, 1) if r.random() < 0.4 else ""))

    def article_parts(self) -> list[str]:
        r = self.r
        parts = []
        runs = 0.7 if r.random() < 0.25 else 0.03  # pages that break lines instead of writing paragraphs
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 30])):
            if r.random() < runs:
                parts.append(self.loose(1, 5))
                continue
            if r.random() < 0.12:
                parts.append(self.mixed())
                continue
            x = r.random()
            if x < 0.7:
                text = self.sentences(1, 8) if r.random() < 0.85 else self.words(1, 2).capitalize() + "."
                if self.sloppy and r.random() < 0.3:
                    parts.append(self.tag("p", "<b>" + text + "<br>", KEEP, close=False))
                else:
                    bits = text.split(" ")
                    if r.random() < 0.3:
                        i = r.randrange(len(bits))
                        bits[i] = r.choice(['<a href="/y">{}</a>', "<em>{}</em>", "<b>{}</b>", "<span>{}</span>"]).format(bits[i])
                    parts.append(self.tag("p", " ".join(bits), KEEP, close=not (self.sloppy and r.random() < 0.5)))
            elif x < 0.78:
                parts.append(self.tag(r.choice(["h2", "h3"]), self.words(1, 6), KEEP))
            elif x < 0.85:
                parts.append(self.tag(r.choice(["ul", "ol"]), "".join(self.tag("li", r.choice([self.words(2, 9), self.sentences(1, 2)]), KEEP) for _ in range(r.randint(2, 6))), KEEP))
            elif x < 0.9:
                parts.append(self.tag("blockquote", self.tag("p", self.sentences(1, 3), KEEP), KEEP))
            elif x < 0.94:
                rows = "".join(self.tag("tr", "".join(self.tag("td", self.words(1, 3), KEEP) for _ in range(3)), KEEP) for _ in range(r.randint(1, 4)))
                parts.append(self.tag("table", rows, KEEP))
            elif x < 0.97:
                parts.append(self.tag("figure", '<img src="z">' + self.tag("figcaption", self.words(3, 9), KEEP), KEEP))
            else:
                parts.append(self.tag("div", self.sentences(1, 6), KEEP))
        return parts

    def page(self) -> str:
        r = self.r
        parts = self.article_parts()
        if r.random() < 0.75:
            parts.insert(0, self.tag(r.choice(["h1", "h1", "h1", "h2"]), self.words(1, 9), KEEP))
        for kind in ("ad", "share", "related", "aside", "form", "notice"):
            if r.random() < 0.12:
                parts.insert(r.randint(1, len(parts)), self.region(kind))
        inner = "".join(parts)
        style = r.random()
        if style < 0.5:
            inner = self.tag("article", inner, KEEP, self.name(_CONTENT_NAMES, 0.3))
        elif style < 0.85:
            inner = self.tag("div", inner, KEEP, self.name(_CONTENT_NAMES, 0.8))
        if r.random() < 0.04:  # a page without an article
            inner = ""
        after = "".join(self.region(k) for k in ("share", "comments", "related", "form", "comments") if r.random() < 0.22)
        side = self.region("aside") if r.random() < 0.35 else ""
        inner = inner + after + side if r.random() < 0.7 else side + inner + after
        if r.random() < 0.3:
            inner = self.tag("main", inner, CONTAINER)
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            inner = self.tag("div", inner, CONTAINER, self.name(_WRAPPERS, 0.8))
        top = "".join(self.region(k) for k in ("notice", "header", "nav", "ad") if r.random() < (0.75 if k == "nav" else 0.45))
        bottom = "<hr>" + r.choice([self.words(2, 8), "&copy; " + self.words(1, 5), " | ".join(self.tag("a", self.words(1, 2)) for _ in range(3))]) if r.random() < 0.1 else ""
        bottom += "".join(self.region(k) for k in ("notice", "nav", "footer") if r.random() < (0.85 if k == "footer" else 0.15))
        end = "" if self.sloppy else "</body></html>"
        head = f"<head><title>{self.words(1, 9)}</title><style>p{{margin:0}}</style></head>" if r.random() < 0.9 else ""
        return f'<!DOCTYPE html><html data-mark="{CONTAINER}">{head}<body data-mark="{CONTAINER}">{top}<!-- ad -->{inner}{bottom}{end}'


def marks(nodes: list[Node]) -> list[int]:
    """The labels of a labelled page: what has no mark is as what it is in; loose text of containers is dropped."""
    out: list[int] = []
    for node in nodes:
        above = out[node.parent] if node.parent >= 0 else CONTAINER
        out.append(int(node.mark) if node.mark else DROP if above == CONTAINER and out else above)
    return out


Model = tuple[Boosted, np.ndarray]


@lru_cache(maxsize=1)
def model() -> Model:
    """The trees, and the steps that decoding takes."""
    xs, ys = [], []
    steps = np.ones((3, 3))
    for i in range(PAGES):
        nodes = parse(Writer(SEED * 100_000 + i).page())
        labels = marks(nodes)
        for node, label in zip(nodes[1:], labels[1:], strict=True):
            steps[labels[node.parent], label] += 1
        xs.append(features(nodes))
        ys.append(np.array(labels))
    x, y = np.ascontiguousarray(np.concatenate(xs)), np.concatenate(ys)
    return Boosted(3).fit(x, y), STEP_WEIGHT * np.log(steps / steps.sum(axis=1, keepdims=True))


def _together(pages: list[str | None]) -> Iterator[list[str | None]]:
    """The pages in order, some at once."""
    some: list[str | None] = []
    letters = 0
    for html in pages:
        if some and (len(some) == AT_ONCE or letters + len(html or "") > LETTERS_AT_ONCE):
            yield some
            some, letters = [], 0
        some.append(html)
        letters += len(html or "")
    if some:
        yield some


def extract_many(pages: list[str | None], fitted: Model) -> list[str]:
    trees, steps = fitted
    out = []
    for some in _together(pages):
        parsed = [parse(h) for h in some]
        scores = trees.log_probabilities(features(*parsed))
        first = 0
        for nodes in parsed:
            out.append(main_text(nodes, decode(nodes, scores[first : first + len(nodes)], steps)))
            first += len(nodes)
    return out


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``pages`` with text and n_chars."""
    sent = pages.sparkSession.sparkContext.broadcast(model())  # of fixed size
    slim = pages.select(*keep, html)
    fields = [f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = extract_many(b.column(len(keep)).to_pylist(), sent.value)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return slim.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))


def op6_dom_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"), "html", ("page_id", "url"))

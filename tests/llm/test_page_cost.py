"""Main text of pages: what it costs, and that features and scores are those of plain versions (F1 of the findings of round 3)."""

import random
import time
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest

from ledgerline.llm import dom_extraction
from ledgerline.llm.boosted_trees import Boosted, _softmax
from ledgerline.llm.dom import parse

KINDS, NAMES, TOKENS = dom_extraction.KINDS, dom_extraction.NAMES, dom_extraction.TOKENS
PIECES = ["<div class='side bar'>", "<div id=Main-Content>", "<p>", "</p>", "<ul>", "<li>", "</ul>", "</div>", "<td>", "<h2>", "<h3>", "<hr>", "<br>", "<a href=x>", "</a>", "<button>", "<input>", "<form hidden>", "</nope>", "<script>var x='<p>'</script>", "<svg>", "<title>", "One, two. Three! ", "&copy; 2024 ", "© x; ", " ", "<", "<!-- c -->", "</body>"]


def odd_pages(n):
    r = random.Random(4)
    return [None, "", "text alone", "<p>", "<div>" * 300 + "deep"] + ["".join(r.choices(PIECES, k=r.choice([3, 10, 60]))) for _ in range(n)]


def least_time(work, times=3):
    took = []
    for _ in range(times):
        began = time.process_time()
        work()
        took.append(time.process_time() - began)
    return min(took)


def test_a_page_costs_little_more_than_reading_its_tags():
    """Against the reader of the standard library, so that the speed of the machine does not count: 6.4 to 7.9 times as much before, 1.3 times after."""
    fitted = dom_extraction.model()
    pages = [dom_extraction.Writer(10**9 + i).page() for i in range(400)]

    def tags():
        for page in pages:
            reader = HTMLParser()
            reader.feed(page)
            reader.close()

    assert least_time(lambda: dom_extraction.extract_many(pages, fitted)) < 3 * least_time(tags)


def plain_features(nodes):
    """Node by node; what is below a node is looked for anew each time."""
    at = dom_extraction._KIND.get
    below = [[j for j, x in enumerate(nodes) if x.parent == i] for i in range(len(nodes))]
    text = lambda x: x.text[0] if x.text else ""
    subtree = lambda i: [i] + [j for c in below[i] for j in subtree(c)]
    above = lambda i: [] if i <= 0 else [nodes[i].parent, *above(nodes[i].parent)]
    named = lambda attrs: [bool(n.search(dom_extraction._CAMEL.sub("-", attrs).replace("_", "-"))) if attrs else False for n in dom_extraction._NAMES]
    length = [sum(len(text(nodes[j])) for j in subtree(i)) for i in range(len(nodes))]
    total = max(1, length[0])
    rows = []
    for i, x in enumerate(nodes):
        under, p = [nodes[j] for j in subtree(i)], max(x.parent, 0)
        siblings = below[p] if i else [0]
        place = siblings.index(i)
        n, links = max(1, length[i]), sum(y.links for y in under)
        leaves, order = sum(bool(y.text) for y in under), sum(len(text(y)) * (1 if y.tag == "#text" else 2) for y in nodes[:i])
        words = {dom_extraction.xxhash.xxh64_intdigest(w) % TOKENS for w in dom_extraction._WORDS.findall(dom_extraction._CAMEL.sub("-", x.attrs).lower())}
        over = np.array([named(nodes[j].attrs) for j in above(i)] or [[False] * len(NAMES)]).any(axis=0)
        rows.append([
            *(k == at(x.tag, 5) for k in range(len(KINDS))), *named(x.attrs), *over, *named(nodes[p].attrs), *(t in words for t in range(TOKENS)),
            len(above(i)), np.log1p(length[i]), np.log1p(len(text(x))), sum(y.linked for y in under) / n, np.log1p(links),
            100 * sum(text(y).count(c) for y in under for c in ".,;!?") / n, np.log1p(sum(y.tag == "p" for y in under)), np.log1p(leaves),
            length[i] / max(1, leaves), sum(y.controls + (y.tag in ("button", "select", "label")) for y in under), sum(y.tag in ("h1", "h2", "h3") for y in under),
            length[i] / total, length[i] / max(1, length[p]), max((length[c] for c in below[i]), default=0) / n, order / total, (order + length[i]) / total,
            place, len(below[p]), Counter(nodes[j].tag for j in siblings)[x.tag] if i else 0, at(nodes[siblings[place - 1]].tag, 5) if place else -1,
            at(nodes[p].tag, 5), len(below[i]), links * 100 / n, "©" in text(x),
        ])
    return np.array(rows, float)


def test_features_of_many_pages_are_those_of_each_node():
    pages = [parse(h) for h in odd_pages(60) + [dom_extraction.Writer(i).page() for i in range(12)]]
    assert dom_extraction.features(*pages) == pytest.approx(np.concatenate([plain_features(x) for x in pages]), rel=1e-6, abs=1e-7)


def test_scores_are_those_of_walking_each_tree():
    r = np.random.default_rng(2)
    x = np.concatenate([r.integers(0, 2, (900, 5)), r.normal(size=(900, 4)).round(2)], axis=1).astype(np.float32)
    for depth in (1, 3, 4):
        trees = Boosted(3, rounds=6, depth=depth).fit(x, (x[:, 0] + (x[:, 6] > 0.3)).astype(int))
        bins, raw = trees.binned(x), np.tile(trees.start, (len(x), 1))
        for k, feature, above, value in trees.trees:
            for i in range(len(x)):
                node = 0
                for _ in range(depth):
                    node = 2 * node + 1 + int(bins[i, feature[node]] > above[node])
                raw[i, k] += value[node - (2**depth - 1)]
        assert np.array_equal(trees.log_probabilities(x), np.log(np.maximum(_softmax(raw), 1e-9)))


def test_pages_at_once_change_nothing(monkeypatch):
    fitted = dom_extraction.model()
    pages = odd_pages(40) + [dom_extraction.Writer(i).page() for i in range(20)]
    want = [dom_extraction.extract_many([page], fitted)[0] for page in pages]
    for letters in (dom_extraction.LETTERS_AT_ONCE, 3000, 1):
        monkeypatch.setattr(dom_extraction, "LETTERS_AT_ONCE", letters)
        assert dom_extraction.extract_many(pages, fitted) == want
    assert dom_extraction.extract_many([], fitted) == []

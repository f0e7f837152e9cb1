"""The operators against brute force on small tables, and trained models on what they have not seen."""

import math
import random
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import (
    benchmark_decontam,
    dom_extraction,
    ftrl,
    language_id,
    license_scan,
    pareto_mixing,
    ring_sharding,
    rule_cascade,
    simhash_neardup,
    suffix_tree_lm,
)
from ledgerline.llm import queries as q
from ledgerline.llm.dom import parse

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(q.oracle_sql()))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(q.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_fingerprints_and_links():
    r = random.Random(3)
    for _ in range(40):
        words = r.choices(["Aé", "b", "C", "dd", "e f"], k=r.randint(0, 30))
        text = r.choice([" ", "\n", "\t "]).join(words)
        lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
        shingles = [" ".join(lower[i : i + 3]) for i in range(max(1, len(lower) - 2))] if lower else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
        assert simhash_neardup.fingerprint(text) % 2**64 == want


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("crowd", [64, 3])
def test_groups_of_near_fingerprints(spark, monkeypatch, crowd):
    """With few and with crowded block keys; chains, stars and a ball of near fingerprints."""
    monkeypatch.setattr(simhash_neardup, "BUCKET", crowd)
    r = random.Random(1)
    found = {r.getrandbits(64) for _ in range(150)}
    centre = r.getrandbits(64)
    found |= {centre} | {centre ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(80)}
    x = r.getrandbits(64)
    for _ in range(30):
        found.add(x)
        x ^= 1 << r.randrange(64) | 1 << r.randrange(64)
    signed = [f - 2**64 if f >= 2**63 else f for f in found]
    near = lambda a, b: ((a ^ b) % 2**64).bit_count() <= 2
    want = components(signed, [p for p in combinations(signed, 2) if near(*p)])
    edges = simhash_neardup.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    got = {n: n for n in signed} | {r.node: r.root for r in simhash_neardup.components(edges).collect()}
    assert got == want


def test_chain_of_links(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501)], "a long, b long")
    got = {r.node: r.root for r in simhash_neardup.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {500: 500, 501: 500}


def test_ring_is_the_sequential_walk():
    """Stretches against keys that walk the ring one after the other, round by round."""
    r = random.Random(5)
    cells = [0] * (1 << ring_sharding.CELL_BITS)
    for _ in range(500):
        cells[r.randrange(len(cells))] += 1
    cells[77] += 300  # a third of the rows at one place
    stretches = ring_sharding.allocate(cells, 7, 16, 0.0)
    assert [s[0] for s in stretches] == [0, *[s[1] for s in stretches[:-1]]] and stretches[-1][1] == 800
    held = Counter()
    for lo, hi, s in stretches:
        held[s] += hi - lo
    assert max(held.values()) - min(held.values()) <= 1
    nodes = ring_sharding.ring(7, 16)
    own = lambda cell: next((s for c, s in nodes if c >= cell), nodes[0][1])
    first = [own(c) for c, n in enumerate(cells) for _ in range(n)]
    stays = sum(first[i] == s for lo, hi, s in stretches for i in range(lo, hi))
    assert stays == sum(min(n, held[s]) for s, n in Counter(first).items())  # a shard is filled by its own rows first
    loose = ring_sharding.allocate(cells, 7, 16, 10.0)
    assert all(first[i] == s for lo, hi, s in loose for i in range(lo, hi))


def test_slots_are_gapless(spark):
    rows = ring_sharding.op4_ring_sharding(spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(by) == 24 and all(sorted(x) == list(range(len(x))) for x in by.values())
    assert {len(x) for x in by.values()} <= {41, 42} and len(rows) == 1000


def test_targets_are_the_iterated_sharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 300, "d": 7, "e": 4000, None: 5, "z": 0}
    got = {r.source: r.target for r in pareto_mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = sorted((s for s in sizes if s), key=str) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    assert got == pytest.approx({s: 3 * sizes[s] if s in capped else level * weight[s] for s in order})


def test_unequal_weights_stop_at_the_bound(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 50 + 1).alias("size"), F.when(F.col("id") < 40, 5.0).otherwise(1.0).alias("w"))
    staged, plan, n = pareto_mixing.plan(docs, F.col("size"), weight=F.col("w"))
    rows = pareto_mixing.copies(staged.df, plan, n).collect()
    heavy, light = ([r.copies for r in rows if (r.doc_id < 40) == x] for x in (True, False))
    assert max(heavy) <= 3 and np.mean(heavy) > 2 * np.mean(light)


def repeated_words(words):
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return len(hit)


def test_rule_measures_against_brute_force():
    r = random.Random(2)
    for _ in range(200):
        words = r.choices("ab", k=r.randint(0, 60)) if r.random() < 0.5 else [str(i % r.choice([9, 11, 30])) for i in range(r.randint(0, 60))]
        assert rule_cascade.Text(" ".join(words)).n_repeat_words == repeated_words(words)
    t = rule_cascade.Text("a b\na b\n\n \nÉ# |\u00a0x\ra b")
    assert (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines) == (8, 11, 2, 1)  # a no-break space is part of a word


def test_the_order_of_rules_does_not_matter():
    texts = ["### " * 30, "word " * 30 + "other " * 30, " ".join(f"W{i}!!" for i in range(40)).upper(), " ".join(f"plain{i}" for i in range(40))]
    for text in texts:
        t = rule_cascade.Text(text)
        assert len({rule_cascade.verdict(t, list(rules)) is None for rules in (rule_cascade.RULES, reversed(list(rule_cascade.RULES)))}) == 1
    assert rule_cascade.verdict(rule_cascade.Text(texts[-1]), list(rule_cascade.RULES)) is None
    assert rule_cascade.order([("symbols", 10.0, 0.5), ("stutter", 1.0, 0.4)])[:2] == ["stutter", "symbols"]


def test_probes_are_the_least_shingles_of_different_functions(spark):
    text = " ".join(f"w{i}" for i in range(200))
    row = benchmark_decontam.items(spark.createDataFrame([(1, text)], "item_id long, text string")).first()
    assert row.n == 196 and len(row.probes) > 8


def test_containment_by_brute_force(spark):
    r = random.Random(9)
    items = [[f"v{r.randrange(400)}" for _ in range(r.randint(5, 60))] for _ in range(30)]
    docs = []
    for i in range(120):
        words = [f"x{r.randrange(50)}" for _ in range(r.randint(0, 300))]
        if i % 2:
            part = list(r.choice(items))
            for _ in range(r.randint(0, 2)):
                part[r.randrange(len(part))] = "edited"
            words[len(words) // 2 : len(words) // 2] = part
        docs.append((i, " ".join(words)))
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    want = {(d, k) for d, t in docs for k, w in enumerate(items) if len(grams(w) & grams(t.split())) >= 0.8 * len(grams(w))}
    found = benchmark_decontam.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in found.collect()} == want and want


def test_license_with_an_edit(spark):
    mit = license_scan.TEMPLATES[9][1].split()
    mit[20] = "edited"
    docs = spark.createDataFrame([(1, "x " * 37 + " ".join(mit) + " y" * 50), (2, "Licensed under another thing"), (3, "released UNDER the mit license.")], "doc_id long, text string")
    assert {(r.doc_id, r.template) for r in license_scan.scan(docs).collect()} == {(1, 9), (3, 2)}
    with pytest.raises(ValueError):
        license_scan.templates(spark, (("X", "too short"),))


def test_temperature_and_elastic_net():
    r = np.random.default_rng(1)
    logits = r.normal(size=(4000, 3))
    labels = np.array([r.choice(3, p=ftrl.probabilities(x / 2.5)) for x in logits])
    assert ftrl.temperature(logits, labels) == pytest.approx(2.5, rel=0.15)
    model = ftrl.Ftrl(10, alpha=0.5, l1=1.0)
    for _ in range(400):
        y = int(r.integers(2))
        model.learn((np.array([y, 5]), np.array([1.0, r.normal()])), y)
    w, _ = model.fitted()
    assert w[1, 0] > 0.5 > -0.5 > w[0, 0] and np.count_nonzero(w) < 10


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    p = q.queries()["op7_language_id"](spark, sf).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL")
    assert p.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    rows = q.queries()["op1_ftrl_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    wins = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert wins > 0.97 and all((r.score >= 0.3) == r.predicted for r in rows)


def test_languages_of_unequal_size(spark, monkeypatch):
    """Languages that are drawn at unequal rates are learned in one random order."""
    monkeypatch.setattr(language_id, "PER_LANGUAGE", 150)
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    p = q.queries()["op7_language_id"](spark, sf).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL")
    assert all(r.right > 0.95 for r in p.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect())


@pytest.fixture(scope="module")
def lm(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    rows = suffix_tree_lm.op10_suffix_tree_lm(spark, SF).collect()
    return texts, {r.doc_id: r for r in rows}


def test_base_scores(lm):
    texts, rows = lm
    learns = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    c = Counter(w for i, t in texts if learns(i) for w in [*t, b"\n"])
    n, v = sum(c.values()), len(c)
    for i, t in texts:
        tokens = [*t, b"\n"]
        assert (rows[i].held_out, rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (not learns(i), len(tokens), sum(w in c for w in tokens), n)
        assert rows[i].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens))
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_tree_scores_by_brute_force(spark):
    """Every distribution adds up to 1, and scores are those of a plain implementation."""
    r = random.Random(4)
    lines = ["a b c d e", "a b x d e", "q r", ""]
    texts = [" ".join(r.choices(lines, k=r.randint(0, 6)) + r.choices("mnop", k=2)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("learns", F.col("doc_id") % 10 != 0)
    got = {x.doc_id: x.score for x in suffix_tree_lm.scores(docs, ("doc_id",)).collect()}
    seqs = {i: ["END", *t.split(), "END"] for i, t in enumerate(texts)}
    train = [s for i, s in seqs.items() if i % 10]
    c1 = Counter(w for s in train for w in s[1:])
    n, v = sum(c1.values()), len(c1)
    n1, n2 = (sum(x == k for x in c1.values()) for k in (1, 2))
    disc = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
    least = max(2.0, suffix_tree_lm.SEQ_SHARE * n)
    root = lambda w: (c1[w] - disc) / n if c1[w] else disc * v / n
    grams = {1: {(w,): x for w, x in c1.items() if x >= least}}
    for k in range(2, suffix_tree_lm.DEPTH + 2):
        counts = Counter(tuple(s[i - k + 1 : i + 1]) for s in train for i in range(k - 1, len(s)))
        grams[k] = {g: x for g, x in counts.items() if x >= least}
    states = {}

    def prob(ctx, w):
        for k in range(len(ctx), 0, -1):
            if (s := states.get(ctx[-k:])) is not None:
                return s[0][w] if w in s[0] else s[1] * prob(ctx[-k:][1:], w)
        return root(w)

    for k in range(1, suffix_tree_lm.DEPTH + 1):
        new = {}
        for g, total in grams[k].items():
            follow = {h[-1]: (x - 0.5) / total for h, x in grams[k + 1].items() if h[:-1] == g}
            shorter = {w: prob(g[1:], w) for w in follow}
            left, left_q = max(1e-9, 1 - sum(follow.values())), max(1e-9, 1 - sum(shorter.values()))
            kl = sum(p * math.log(p / shorter[w]) for w, p in follow.items()) + left * math.log(left / left_q)
            if kl >= suffix_tree_lm.MIN_KL and kl * total >= suffix_tree_lm.MIN_GAIN:
                new[g] = (follow, left / left_q)
        states |= new
    assert any(len(g) > 1 for g in states)
    for g in [(), *states]:
        assert sum(prob(g, w) for w in c1) + prob(g, "never seen") == pytest.approx(1, abs=1e-6)
    for i, s in seqs.items():
        want = sum(math.log10(prob(tuple(s[max(0, j - suffix_tree_lm.DEPTH) : j]), s[j])) for j in range(1, len(s)))
        assert got[i] == pytest.approx(want)


def test_parser():
    nodes = parse('<head><title>t</title></head><body><script>var a="</p>"</script><p>One<b> two</b><p>th&eacute;<br>re<ul><li>x<li>y</ul>tail<!-- no -->')
    assert [(n.tag, n.text) for n in nodes if n.text and n.parent != -2] == [("p", ["One two"]), ("p", ["thé re"]), ("li", ["x"]), ("li", ["y"]), ("#text", ["tail"])]


@pytest.mark.parametrize(
    "before",
    ['<embed src="x">', "<head><title>t</title><meta charset=x>", "<head><title>t<body>", "<head><style>p{}<body>", *[f"<{t} a=b>" for t in "iframe object svg audio video canvas noscript template".split()]],
)
def test_parser_keeps_what_follows(before):
    nodes = parse(f"{before}<p>One</p><p>Two</p>")
    assert [n.text for n in nodes if n.text and n.parent != -2] == [["One"], ["Two"]]
    closed = parse("<p>One</p><svg><title>x</title></svg><iframe>y</iframe><noscript><p>z</p></noscript><p>Two</p><script>v='<p>'")
    assert [n.text for n in closed if n.text and n.parent != -2] == [["One"], ["Two"]]


def test_no_kept_block_in_a_dropped_one():
    r = np.random.default_rng(0)
    nodes = parse(dom_extraction.Writer(5).page())
    steps = dom_extraction.model()[1]
    labels = dom_extraction.decode(nodes, np.log(r.dirichlet([0.3] * 3, len(nodes))), steps)
    for node, label in zip(nodes, labels, strict=True):
        if node.parent >= 0 and labels[node.parent] == dom_extraction.DROP:
            assert label == dom_extraction.DROP


def test_pages_not_seen():
    fitted = dom_extraction.model()
    pages = [dom_extraction.Writer(10**9 + i).page() for i in range(60)]
    right = total = 0
    for page, got in zip(pages, dom_extraction.extract_many(pages, fitted), strict=True):
        nodes = parse(page)
        want = Counter(dom_extraction.main_text(nodes, dom_extraction.marks(nodes)).split())
        right += 2 * sum((want & Counter(got.split())).values())
        total += sum(want.values()) + len(got.split())
    assert right / total > 0.95


ABOUT = "The old bridge over the river was closed in spring, and the town has repaired it since. "
REST = "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/c>Contact</a></ul></nav>", "<footer><p>&copy; 2024 Imprint</p></footer>"


@pytest.mark.parametrize(
    "article",
    [
        f"<div class=article>Intro: {ABOUT}<br>More text. {ABOUT}<h2>A heading</h2>Tail: {ABOUT}</div>",
        f"<article><h1>A heading</h1><p>{ABOUT}</p><ul><li>Item one: {ABOUT}<ul><li>Inner point</li></ul></li><li>Item two</li></ul><p>{ABOUT}</p></article>",
        f"<article><h1>A heading</h1><p>{ABOUT}</p><table><tr><td>Cell: {ABOUT}<p>Inside. {ABOUT}</p></td></tr></table><p>{ABOUT}</p></article>",
        f"<h1>A heading</h1>Start. {ABOUT}{ABOUT}<br><br>{ABOUT}<div class=advert>Buy now</div>End. {ABOUT}{ABOUT}<br><br>{ABOUT}",
        f"<article><p>{ABOUT}</p><blockquote>Quote: {ABOUT}<p>Inside. {ABOUT}</p></blockquote></article>",
    ],
)
def test_text_beside_blocks(article):
    """Hand-written pages; the words of the article, and none of what is around it."""
    got = dom_extraction.extract_many([f"<html><head><title>t</title></head><body>{REST[0]}{article}{REST[1]}</body></html>"], dom_extraction.model())[0]
    want = " ".join(" ".join(n.text) for n in parse(article.replace("<div class=advert>Buy now</div>", "<hr>")) if n.text and n.parent != -2)
    assert " ".join(got.split()) == " ".join(want.split())

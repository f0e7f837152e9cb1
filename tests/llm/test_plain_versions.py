"""The trained operators' scoring, the decoding of pages and the shards against plain versions that share no code with them."""

import itertools
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import dom_extraction, ftrl_quality, language_id, ring_sharding
from ledgerline.llm.dom import Node

SF = "/root/testdata/sf0.001"
WRAP = 2**64
MIX = 0x9E3779B97F4A7C15


def quality(text, weights, bias):
    tokens = [xxhash.xxh64_intdigest(t) for word in re.split(r"[ \t\n\v\f\r]+", text or "") for t in re.findall(r"\w+|[^\w\s]+", word)]
    if not tokens:
        return 1 / (1 + math.exp(-(bias + float(weights[0]))))
    tokens = [0x5851F42D4C957F2D if i and tokens[i - 1] == t else t for i, t in enumerate(tokens)]
    logit = bias
    for n in (1, 2, 3):
        runs = [tokens[i : i + n] for i in range(len(tokens) - n + 1)]
        total = 0.0
        for run in runs:
            g = 0
            for t in run:
                g = ((g ^ g >> 29) * MIX + t) % WRAP
            m = (g ^ g >> 32) * MIX % WRAP
            total += float(weights[m >> 44]) * (-1 if m >> 20 & 1 else 1)
        logit += total / len(runs) if runs else 0.0
    return 1 / (1 + math.exp(-logit))


def test_quality_scores_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, " \n "), (10**6 + 2, "one"), (10**6 + 3, "no no no no!! no!! é|é # #"), (10**6 + 4, "!!! ...  x")], docs.schema)
    docs = docs.unionByName(extra)
    weights = np.random.default_rng(5).normal(size=ftrl_quality.SIZE).astype(np.float32)
    got = {r.doc_id: r for r in ftrl_quality.score(docs.withColumn("held_out", F.lit(False)), weights, 0.25).collect()}
    for r in docs.collect():
        want = quality(r.text, weights, 0.25)
        assert got[r.doc_id].score == pytest.approx(want, abs=1e-5) and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)


def language(text, model):
    kinds = [(c, unicodedata.category(c)[0]) for c in (text or "").lower()]
    if not any(k == "L" for _, k in kinds):
        return "und", 0.0
    words = "".join(c if k in "LM" else " " for c, k in kinds).split(" ")
    s = f" {' '.join(w for w in words if w)} "
    places = []
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            x = 0
            for c in s[i : i + n]:
                x = x << 21 | ord(c)
            places.append((x % WRAP) * MIX % WRAP >> 49)
    counts = {p: places.count(p) for p in set(places)}
    values = {p: n * float(model.idf[p]) for p, n in counts.items()}
    norm = math.sqrt(sum(v * v for v in values.values()))
    logits = [sum(v / norm * float(model.w[p, k]) for p, v in values.items()) + float(model.b[k]) for k in range(len(model.names))]
    e = [math.exp((x - max(logits)) / model.t) for x in logits]
    best = max(range(len(e)), key=lambda k: (e[k], -k))
    rare = sum(float(model.idf[p]) for p in places) / len(places)
    excess = (rare - model.mean) / math.sqrt(model.between + model.within / len(places) + 1e-9) / model.usual
    return model.names[best], e[best] / sum(e) * (1.0 if excess <= 1 else math.exp(1 - excess**2))


def test_languages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.learn(docs, F.lit(True))
    texts = [r.text for r in docs.orderBy(F.length("text")).limit(60).collect()] + ["½", "Straße, café – naïve!", "नमस्ते दुनिया", "x", "a1b2 c-d", "", None]
    for t in texts:
        (lang, p), (want, q) = language_id.predict(t, model), language(t, model)
        assert lang == want and p == pytest.approx(q, rel=1e-3, abs=1e-6)


def test_decoding_is_the_best_of_all_labellings():
    r = np.random.default_rng(3)
    draw = random.Random(3)
    may = {0: (0, 1, 2), 1: (1, 2), 2: (2,)}
    for _ in range(60):
        n = draw.randint(1, 7)
        nodes = [Node("div", -1)] + [Node("p", draw.randrange(i)) for i in range(1, n)]
        scores, steps = np.log(r.dirichlet([0.5] * 3, n)), np.log(r.dirichlet([1] * 3, 3))
        worth = lambda y, nodes=nodes, scores=scores, steps=steps: sum(scores[i, k] + (steps[y[nodes[i].parent], k] if i else 0) for i, k in enumerate(y))
        allowed = [y for y in itertools.product(range(3), repeat=n) if all(y[i] in may[y[nodes[i].parent]] for i in range(1, n))]
        got = dom_extraction.decode(nodes, scores, steps)
        assert tuple(got) in set(allowed) and worth(got) == pytest.approx(max(map(worth, allowed)))


def test_shards_hold_what_the_contract_says(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = ring_sharding.op4_ring_sharding(spark, SF).collect()
    assert len(rows) == len(docs) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    held = {}
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(data) + 8, zlib.crc32(data)) and 0 <= r.shard < 24
        held.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in held.values())
    assert max(map(len, held.values())) - min(map(len, held.values())) <= 1
    again = {(r.doc_id, r.shard, r.slot) for r in ring_sharding.op4_ring_sharding(spark, SF).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}

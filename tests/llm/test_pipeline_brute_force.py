"""The rows of the whole pipeline, and of each stage, against plain Python over a small table."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import language_id, ring_sharding, simhash_neardup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("small")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc(), "item_id").first().text
    copies = docs.filter("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 1000)  # exact copies
    leaks = docs.filter("doc_id BETWEEN 40 AND 44").withColumns({"doc_id": F.col("doc_id") + 2000, "text": F.concat(F.lit("Before "), F.lit(item), F.lit(" "), "text")})
    silent = docs.filter("doc_id BETWEEN 50 AND 54").withColumns({"doc_id": F.col("doc_id") + 3000, "text": F.when(F.col("doc_id") % 2 == 0, "12 34 !!")})
    docs.unionByName(copies).unionByName(leaks).unionByName(silent).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))).write.parquet(f"{where}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{where}/benchmark.parquet")
    return str(where)


def words(text):
    return (text or "").encode().split()


def by_language(rows, model):
    found = [(r, language_id.predict(r["text"], model)) for r in rows]
    return [r for r, (lang, p) in found if lang != "und" and p >= corpus_pipeline.LEAST_CERTAINTY]


def without_copies(rows):
    fps = [simhash_neardup.fingerprint(r["text"]) % 2**64 for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def without_items(rows, items):
    grams = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(max(1, len(w) - 4))} if (t or "").split() else set()
    wanted = [grams(t) for t in items]
    return [r for r in rows if not any(w and len(w & (g := grams(r["text"]))) >= 0.8 * len(w) for w in wanted)]


def mixed(rows):
    size = {r["doc_id"]: len(words(r["text"])) for r in rows}
    of = {}
    for r in rows:
        of.setdefault(r["source"], []).append(r)
    order = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + [None] * (None in of)
    total = {s: sum(size[r["doc_id"]] for r in of[s]) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        level = (sum(total.values()) - sum(3 * total[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and level * weight[s] >= 3 * total[s]}
        if not more:
            break
        capped |= more
    out = []
    for s in order:
        target = 3.0 * total[s] if s in capped else level * weight[s]
        rate = min(3.0, target / total[s]) if total[s] else 0.0
        sure, p = int(rate), rate - int(rate)
        u = lambda r: int(hashlib.md5(f"mix-1|{r['doc_id']}".encode()).hexdigest()[:13], 16)
        left = target - sure * total[s]
        ranked = sorted(of[s], key=lambda r: (u(r), r["doc_id"]))
        taken, up_to = set(), 0
        for r in ranked:
            up_to += size[r["doc_id"]]
            if p > 0 and up_to <= left:
                taken.add(r["doc_id"])
        gap = target - sum(size[r["doc_id"]] * (sure + (r["doc_id"] in taken)) for r in ranked)
        fills = [(abs(size[r["doc_id"]] - gap), u(r), r["doc_id"]) for r in ranked if p > 0 and r["doc_id"] not in taken and size[r["doc_id"]] and abs(size[r["doc_id"]] - gap) < gap]
        if fills:
            taken.add(min(fills)[2])
        for r in ranked:
            out += [r] * (sure + (r["doc_id"] in taken))
    return out


def sharded(rows, n):
    at = lambda r: xxhash.xxh64_intdigest(str(r["doc_id"]), seed=42)
    crc = lambda r: zlib.crc32(r["text"].encode())
    ordered = sorted(rows, key=lambda r: (at(r), r["doc_id"], crc(r)))
    cells = [0] * (1 << ring_sharding.CELL_BITS)
    for r in ordered:
        cells[at(r) >> 64 - ring_sharding.CELL_BITS] += 1
    used = Counter()
    out = []
    for lo, hi, s in ring_sharding.allocate(cells, n, 128, 0.0):
        out += [(r["doc_id"], s, used[s] + i) for i, r in enumerate(ordered[lo:hi])]
        used[s] += hi - lo
    return out


def test_pipeline_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    steps = [by_language(rows, language_id.learn(docs, F.lit(True)))]
    steps.append(without_copies(steps[-1]))
    steps.append(without_items(steps[-1], [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]))
    steps.append(mixed(steps[-1]))
    now = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES[:-1], steps, strict=True):
        got = stage(spark, now, small)
        kept = [r.asDict() for r in got.collect()]
        assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in want)
        now = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in kept], docs.schema)
    assert len(steps[0]) < len(rows) and len(steps[1]) < len(steps[0]) - 25 and len(steps[2]) <= len(steps[1]) - 5
    want = Counter(sharded(steps[-1], corpus_pipeline.SHARDS))
    assert Counter((r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, small).collect()) == want


def test_near_copies_by_brute_force(spark):
    """Groups are those of all pairs of five-word sets at 0.8; a crowd in one band, chains, exact copies, no words."""
    r = random.Random(7)
    text = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    texts = ["", None, "one two", "One  two", "one two three"]
    for _ in range(30):
        base = text(200)
        texts.append(" ".join(base))
        for changed in (1, 2, 3, 4, 6, 12):
            near = list(base)
            for i in r.sample(range(200), changed):
                near[i] = "changed"
            texts.append(" ".join(near))
    crowd = text(300)
    for i in range(150):
        crowd[i % 150] = f"step{i}"  # each is near to the one before
        texts.append(" ".join(crowd))
    texts += texts[5:20]
    grams = [{tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(max(1, len(w) - 4))} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(grams):
        for j, b in enumerate(grams[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == {find(i) for i in range(len(texts))}

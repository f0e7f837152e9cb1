"""The whole pipeline against plain Python, with near-duplicates by the similarity of five-word shingles."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import language_id

from .test_pipeline_brute_force import by_language, mixed, sharded, small, without_items  # noqa: F401 - small is a fixture


def one_of_near(rows):
    grams = [{tuple(w[i : i + 5]) for w in [(r["text"] or "").encode().lower().split()] for i in range(max(1, len(w) - 4))} for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(grams):
        for j, b in enumerate(grams[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def test_stages_and_run(spark, small):  # noqa: F811
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    steps = [by_language(rows, language_id.learn(docs, F.lit(True)))]
    for step in (one_of_near, lambda x: without_items(x, items), mixed):
        steps.append(step(steps[-1]))
    now = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES[:-1], steps, strict=True):
        kept = [r.asDict() for r in stage(spark, now, small).collect()]
        assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in want)
        now = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in kept], docs.schema)
    assert len(steps[0]) < len(rows) and len(steps[1]) < len(steps[0]) - 25 and len(steps[2]) < len(steps[1])
    want = Counter(sharded(steps[-1], corpus_pipeline.SHARDS))
    assert Counter((r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, small).collect()) == want

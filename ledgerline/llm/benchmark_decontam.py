"""Benchmark decontamination: which documents contain test items.

Size-partitioned MinHash containment search. Items are partitioned by their number of shingles, and each partition has
its own way of asking (``PARTITIONS``). An item of up to 16 shingles is looked up by all of them, so the shingles
that a document has are its containment. A larger one is probed by its MinHash under K functions: the shingle whose
hash is least under the function. A document that contains the share c of the item's shingles contains each such
shingle with probability c, however long it is, fewer than ``need`` of the K hit with a
probability of 1e-6 at most; a document that shares a passage with many items hits few of each, and is no candidate.
Candidates are then verified by exact containment of the item's shingles in the document's, as texts.

Items shorter than a shingle are a partition of their own for each number of words: the item is found where a
document has its words in a row. Only the lengths that occur among the items are looked up.

A pass over all whole texts hashes the shingles and joins them with the probes; only candidate documents are read
again. The probes, items and candidates are broadcast when counted to be within fixed bounds, and joined by shuffle
beyond them.

Defined cases: null and empty texts, of items and of documents, have no shingles and match nothing; an item of fewer than
five words counts as one shingle; equal rows of documents or items give one result; a null doc_id is reported as null; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staged, read, scratch
from .shingles import SHINGLE, keyed, run_hashes, run_texts, split_words

THRESHOLD = 0.8
#: By partition: shingles up to, and K functions; None: all shingles.
PARTITIONS = ((16, None), (64, 16), (2**31 - 1, 24))
MISS = 1e-6
BROADCAST_PROBES, BROADCAST_DOCS = 500_000, 1_000_000


def need(k: int, threshold: float) -> int:
    """The most hits of k to ask for, so that a document that contains the threshold's share of an item's shingles has
    fewer with a probability of MISS at most."""
    below, hits = 0.0, 0
    while hits < k and (below := below + comb(k, hits) * threshold**hits * (1 - threshold) ** (k - hits)) <= MISS:
        hits += 1
    return max(1, hits)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most so many rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _least(i: int) -> Column:
    """The shingle with the least hash under function i."""
    return F.array_min(F.transform("hashes", lambda h: F.struct(F.xxhash64(h, F.lit(i)).alias("rank"), h.alias("h"))))["h"]


def _counted(chosen: Column) -> Column:
    return F.transform(F.array_distinct(chosen), lambda h: F.struct(h.alias("h"), F.size(F.filter(chosen, lambda c: c == h)).alias("times")))


def items(benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, length, shingles, n, partition, probes, need) of the distinct items that have a word: length is that of the
    runs of words that are looked up, probes are hashes with the number of functions that chose them."""
    words = benchmark.select("item_id", "text").distinct().select("item_id", split_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    x = words.withColumn("length", F.least(F.size("words"), F.lit(SHINGLE)))
    x = x.select("item_id", "length", F.array_distinct(run_texts(F.col("words"), F.col("length"))).alias("shingles"), F.array_distinct(_hashes(F.col("words"), F.col("length"))).alias("hashes"))
    x = x.withColumn("n", F.size("shingles"))
    (small, _), *larger = PARTITIONS
    partition = sum((F.col("n") > upto).cast("int") for upto, _ in PARTITIONS[:-1])
    probes = F.when(F.col("n") <= small, F.transform("hashes", lambda h: F.struct(h.alias("h"), F.lit(1).alias("times"))))
    least = F.when(F.col("n") <= small, F.ceil(threshold * F.col("n") - 1e-9).cast("int"))
    for upto, k in larger:
        times = _counted(F.array(*[_least(i) for i in range(k)]))
        probes, least = probes.when(F.col("n") <= upto, times), least.when(F.col("n") <= upto, F.lit(need(k, threshold)))
    return x.select("item_id", "length", "shingles", "n", partition.alias("partition"), probes.alias("probes"), least.alias("need"))


def _hashes(words: Column, length: Column) -> Column:
    """Hashes of the runs of ``length`` words, for a length that differs by row."""
    out = run_hashes(words, SHINGLE)
    for n in range(1, SHINGLE):
        out = F.when(length == n, run_hashes(words, n)).otherwise(out)
    return out


def contained(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, item_id, containment, n_shingles) of all pairs at or above the threshold."""
    known = Staged(items(benchmark, threshold).withColumn("item", F.xxhash64("item_id", "shingles")), "items").df
    lengths = sorted(r.length for r in known.select("length").distinct().collect())  # 1 to SHINGLE
    rows = keyed(docs)
    probes = sized(known.select("item", "need", F.explode("probes").alias("p")).select("item", "need", "p.h", "p.times"), BROADCAST_PROBES)
    words = rows.select("doc_id", "text_hash", split_words(F.col("text")).alias("words"))
    runs = F.concat(*[run_hashes(F.col("words"), n) for n in lengths]) if lengths else F.array().cast("array<bigint>")
    # the outer explode keeps the optimizer from evaluating the runs again in a filter below it
    found = words.select("doc_id", "text_hash", F.explode_outer(runs).alias("h")).join(probes, "h").distinct()
    pairs = found.groupBy("doc_id", "text_hash", "item", "need").agg(F.sum("times").alias("hit")).filter("hit >= need")
    candidates = Staged(pairs.groupBy("doc_id", "text_hash").agg(F.collect_list("item").alias("found")), "candidates").df
    by_doc = sized(candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "found"), BROADCAST_DOCS)
    again = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")))
    texts = again.select("doc_id", "text_hash", "found", split_words(F.col("text")).alias("words"))
    # the runs of the whole text are built once, and an item is compared with those of its length
    of_doc = F.array_distinct(F.concat(*[run_texts(F.col("words"), F.lit(n)) for n in lengths])) if lengths else F.array().cast("array<string>")
    texts = texts.select("doc_id", "text_hash", "found", of_doc.alias("of_doc"))
    few = texts.select("doc_id", "text_hash", "of_doc", F.explode_outer("found").alias("item"))
    both = few.join(sized(known.select("item", "item_id", "shingles", "n"), BROADCAST_PROBES // 50), "item")
    share = F.size(F.array_intersect("shingles", "of_doc")) / F.col("n")
    out = both.select("doc_id", "text_hash", "item_id", share.alias("containment"), F.col("n").cast("long").alias("n_shingles"))
    return out.filter(F.col("containment") >= threshold)


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    with scratch() as keep:
        keep.append(Staged(contained(docs, benchmark, threshold).select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct(), "contaminated"))
    bad = sized(keep[0].df, BROADCAST_DOCS)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad_id"]) & (F.xxhash64(docs["text"]) == bad["__bad_hash"]), "left_anti")


def op2_benchmark_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"), F.max("n_shingles").alias("n_shingles"))


ORACLE_OP2 = """
WITH i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS g
      FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM i WHERE len(w) >= 5)),
n AS (SELECT item_id, count(*) AS n FROM s GROUP BY item_id),
d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM d WHERE len(w) >= 5)),
m AS (SELECT doc_id, item_id, count(*) AS hit FROM s JOIN t USING (g) GROUP BY doc_id, item_id),
b AS (SELECT DISTINCT item_id, ' ' || array_to_string(w, ' ') || ' ' AS g FROM i WHERE len(w) BETWEEN 1 AND 4),
r AS (SELECT doc_id, ' ' || array_to_string(w, ' ') || ' ' AS g FROM d WHERE len(w) > 0)
SELECT doc_id, item_id, hit / n AS containment, CAST(n AS BIGINT) AS n_shingles FROM m JOIN n USING (item_id) WHERE hit / n >= 0.8
UNION
SELECT doc_id, item_id, CAST(1 AS DOUBLE), CAST(1 AS BIGINT) FROM b JOIN r ON contains(r.g, b.g)
"""

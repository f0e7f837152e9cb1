"""SimHash near-duplicates by pigeonhole blocks.

The fingerprint of a text has bit b set if over half of the hashes of its 3-word shingles have. Two fingerprints that
differ in 2 bits or fewer agree in two at least of their four blocks of 16 bits, so they share one of six block keys:
fingerprints are joined on these keys and pairs verified by Hamming distance. Texts with one fingerprint are one
member from the start. A key that more than BUCKET fingerprints share is not paired: each of its fingerprints lists
the 65 points within one bit, two fingerprints are within 2 bits if and only if they share a point, and no point has
more than 65 of them; so links stay exact and work grows with the members, not with their pairs.

Groups are the connected components of the links, found by alternating large-star and small-star steps on tables in
the shared folder; nothing but counts reaches the driver.

Defined cases: a null text has no words; a text without words has the fingerprint zero and links like any other; one
of fewer than three words has one shingle; a row without a doc_id takes part, and its group's id is the smallest
doc_id that the group has, null if none has one; repeated rows are copies of each other; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staged, parts, read, scratch, short_lived_shuffles, small_or_not

SEED, SHINGLE, DISTANCE = 42, 3, 2
BLOCKS = 4
BUCKET = 64
BROADCAST_IDS = 1_000_000
CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # lower() of bytes and split() of bytes know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK], strict=True)), np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp), fp as a signed 64-bit number."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([fingerprint(t) for t in b.column(2).to_pylist()], pa.int64())], names=["doc_id", "text_hash", "fp"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, f"doc_id {key}, text_hash long, fp long")


def block_keys(fp: Column, blocks: int = BLOCKS, agree: int = BLOCKS - DISTANCE) -> Column:
    """The keys of a fingerprint: the blocks of every choice of ``agree`` of ``blocks``, with the number of the choice above them. Any
    two fingerprints within blocks - agree bits have one in common."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = lambda i: F.shiftrightunsigned(fp, edge[i]).bitwiseAND((1 << edge[i + 1] - edge[i]) - 1)

    width = max(edge[i + 1] - edge[i] for i in range(blocks)) * agree  # choices of unlike widths must not share a key

    def key(number: int, chosen: tuple[int, ...]) -> Column:
        out = F.lit(0).cast("long")
        for i in chosen:
            out = F.shiftleft(out, edge[i + 1] - edge[i]) + block(i)
        return F.lit(number << width).cast("long") + out

    return F.array(*[key(c, chosen) for c, chosen in enumerate(combinations(range(blocks), agree))])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of which each two connected ones are within DISTANCE bits, and
    through which all such are connected."""
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = Staged(keyed.join(shared, "key"), "simhash-met").df
    few = met.filter(F.col("n") <= BUCKET)
    a, b = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = a.join(b, "key").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)).select("a", "b")
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    crowd = met.filter(F.col("n") > BUCKET).select("fp").distinct()
    points = crowd.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    around = points.groupBy("point").agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1)  # 65 at most
    stars = around.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a < b")
    return pairs.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge."""
    now = Staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    seen = None
    while True:
        mark = tuple(now.df.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now.df.select(F.col("v").alias("node"), F.col("u").alias("root")).union(now.df.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        seen = mark
        both = now.df.select(F.col("v").alias("x"), F.col("u").alias("y")).union(now.df.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = Staged(both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct(), "large-star")
        least = large.df.groupBy("v").agg(F.min("u").alias("m"))
        small = large.df.join(least, "v").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select(F.col("e.u").alias("v"), F.col("e.m").alias("u"))
        after = Staged(small.filter("v <> u").distinct(), "edges")
        now.drop()
        large.drop()
        now = after


def groups(docs: DataFrame) -> tuple[Staged, DataFrame]:
    """The staged fingerprints, and (fp, component_id, keeper): keeper is the (doc_id, text_hash) of the group's first row."""
    found = Staged(fingerprints(docs), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = Staged(found.df.groupBy("fp").agg(F.min(row).alias("first")), "simhash-distinct").df
    roots = components(links(distinct))
    member = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    first = member.groupBy("root").agg(F.min("first").alias("keeper"))
    return found, member.select("fp", "root").join(first, "root").select("fp", F.col("keeper.doc_id").alias("component_id"), "keeper")


def one_of_each(docs: DataFrame, grouped: Callable[[DataFrame], tuple[Staged, DataFrame]] = groups) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest doc_id."""
    with scratch() as keep, short_lived_shuffles(docs.sparkSession):
        found, by_fp = grouped(docs)
        rows = found.df.join(by_fp, "fp").select("doc_id", "text_hash", (F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_hash") == F.col("keeper.text_hash"))).alias("keeps"))
        keys = rows.groupBy("doc_id", "text_hash", "keeps").agg(F.count("*").alias("n"))
        # one row a key, so that the join does not multiply; keys of a single row that stays are not listed
        keep.append(Staged(keys.filter("NOT keeps OR n > 1").select(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash"), "keeps"), "simhash-listed"))
    listed = keep[0].df
    gone, _ = small_or_not(listed.select("__gone_id", "__gone_hash"), BROADCAST_IDS)
    at = lambda keys: docs["doc_id"].eqNullSafe(keys["__gone_id"]) & (F.xxhash64(docs["text"]) == keys["__gone_hash"])
    single = docs.join(gone, at(gone), "left_anti")
    repeated = listed.filter("keeps").select("__gone_id", "__gone_hash")
    if not repeated.head(1):
        return single
    again = docs.join(repeated, at(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(again)


def op8_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, by_fp = groups(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.df.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

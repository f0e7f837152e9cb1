"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points of a ring; a row belongs to the first point clockwise of the hash of its
key. A shard holds a bounded number of rows: those that overflow it continue clockwise to the next point whose shard
has room. With ``slack=0`` the bounds add up to the number of rows, so the shards differ by one row at most; with a
slack, a bound is (1 + slack) times the mean and fewer rows leave their first shard.

Only counts per ring cell (2 ** CELL_BITS of them, whatever the input) reach the driver; rows are ordered by ring
position with one range exchange, and a row's rank decides which stretch of the allocation it falls in.

Defined cases: a null key hashes as the empty text; rows with equal keys sit at the same point in the order of the
tie columns and get slots of their own (rows that are equal in all of these are ordered in one task, which holds their keys,
not their texts, where the caller passes slim rows); an empty table gives no rows; columns of the input that have the name of an
output column are replaced; other columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staged, read

CELL_BITS = 16
OUTPUT = ("shard", "slot")


def ring(n_shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    point = lambda s, v: xxhash.xxh64_intdigest(f"shard {s} node {v}", seed=7) >> (64 - CELL_BITS)
    return sorted((point(s, v), s) for s in range(n_shards) for v in range(virtual_nodes))


def bounds(demand: list[int], total: int, slack: float) -> list[int]:
    """Rows that each shard may hold. Without slack they add up to the total, and the shards that most rows
    hash to get the odd rows."""
    n = len(demand)
    if slack > 0:
        return [int(-(-total * (1 + slack) // n))] * n
    least, odd = divmod(total, n)
    most = sorted(range(n), key=lambda s: (-demand[s], s))[:odd]
    return [least + (s in set(most)) for s in range(n)]


def allocate(cells: list[int], n_shards: int, virtual_nodes: int, slack: float) -> list[tuple[int, int, int]]:
    """Stretches (first rank, end rank, shard) that cover all ranks in ring order, from the counts per cell."""
    nodes = ring(n_shards, virtual_nodes)
    starts = [0]
    for c in cells:
        starts.append(starts[-1] + c)
    total = starts[-1]
    # ranks of a node: cells after the previous node's, up to and with its own; the first also takes what wraps
    edges = [starts[cell + 1] for cell, _ in nodes]
    waiting = [(i, edges[i - 1] if i else 0, edges[i]) for i in range(len(nodes))] + [(0, edges[-1], total)]
    waiting = [w for w in waiting if w[1] < w[2]]
    demand = [0] * n_shards
    for i, lo, hi in waiting:
        demand[nodes[i][1]] += hi - lo
    room = bounds(demand, total, slack)
    done: list[tuple[int, int, int]] = []
    while waiting:
        over = []
        for i, lo, hi in waiting:
            shard = nodes[i][1]
            fits = min(room[shard], hi - lo)
            if fits:
                room[shard] -= fits
                done.append((lo, lo + fits, shard))
            if lo + fits < hi:
                over.append(((i + 1) % len(nodes), lo + fits, hi))
        waiting = over
    return sorted(done)


def shard(df: DataFrame, key: str, n_shards: int, virtual_nodes: int = 128, slack: float = 0.0, ties: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with shard (0 to n_shards - 1) and slot (gapless from 0 in each shard). Equal rows apart, the result
    depends on the rows alone."""
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in OUTPUT]
    hashed = F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    row = df.select(hashed.alias("h"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    # as an unsigned number: the sign bit flipped
    row = row.select(F.col("h").bitwiseXOR(F.lit(-(2**63))).alias("at"), F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int").alias("cell"), "row")
    order = [F.col("at"), *[F.col("row").getField(c) for c in (key, *ties)]]
    placed = Staged(row.orderBy(*order).select("cell", "row", F.monotonically_increasing_id().alias("id")), "ring")
    part, here = F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1)
    cells = [0] * (1 << CELL_BITS)
    parts: dict[int, int] = {}
    for p, cell, n in placed.df.groupBy(part, "cell").count().collect():  # at most cells + parts rows: they are in order
        cells[cell] += n
        parts[p] = parts.get(p, 0) + n
    stretches = allocate(cells, n_shards, virtual_nodes, slack)
    offsets, before = [], 0
    for p in sorted(parts):
        offsets.append((p, before))
        before += parts[p]
    used = [0] * n_shards
    plan = []
    firsts = [0]
    for c in cells:
        firsts.append(firsts[-1] + c)
    for lo, hi, s in stretches:
        cell = bisect_left(firsts, lo + 1) - 1
        at = lo
        while at < hi:  # a row of the plan for each cell that the stretch touches
            end = min(hi, firsts[cell + 1])
            if end > at:
                plan.append((cell, at, end, s, used[s] + at - lo))
            at = max(at, end)
            cell += 1
        used[s] += hi - lo
    # both tables have a bounded size: cells + stretches, and the number of partitions
    table = F.broadcast(_frame(spark, plan, "p_cell int, lo long, hi long, shard int, base long"))
    offset = F.broadcast(_frame(spark, offsets, "part int, before long"))
    ranked = placed.df.select(part.cast("int").alias("part"), here.alias("here"), "cell", "row").join(offset, "part").withColumn("rank", F.col("before") + F.col("here"))
    found = ranked.join(table, (F.col("cell") == F.col("p_cell")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return found.select(*[F.col("row").getField(c).alias(c) for c in kept], "shard", (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], schema)
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"int": "int32", "long": "int64"}
    return spark.createDataFrame(pd.DataFrame(rows, columns=names).astype({x.split()[0]: types[x.split()[1]] for x in schema.split(", ")}), schema)


def documents_slim(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"), F.crc32("text").alias("text_crc32"))


def op4_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(documents_slim(read(spark, sf_dir, "documents")), "doc_id", 24, ties=("text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

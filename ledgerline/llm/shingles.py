"""Word shingles as DataFrame expressions.

A text is lower-cased and cut into words; a shingle is five words in a row. A text of fewer words has one shingle, all
of its words; one without words has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5


def split_words(text: Column) -> Column:
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def _starts(words: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - SHINGLE))


def shingle_hashes(words: Column) -> Column:
    """One 64-bit hash for each shingle, in order."""
    hashed = F.transform(_starts(words), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))
    return F.when(F.size(words) > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def shingle_texts(words: Column) -> Column:
    """The shingles themselves, in order."""
    joined = F.transform(_starts(words), lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))
    return F.when(F.size(words) > 0, joined).otherwise(F.array().cast("array<string>"))


def run_hashes(words: Column, n: int) -> Column:
    """Hashes of the runs of n words, in order; none if there are fewer words. Runs of different n have different hashes."""
    starts = F.sequence(F.lit(0), F.size(words) - n)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))
    return F.when(F.size(words) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def run_texts(words: Column, n: Column) -> Column:
    """The runs of n words themselves, in order."""
    joined = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): rows that agree in both keys are copies."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def hits(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, h) of the shingles of ``docs`` (keyed) whose hash is in ``wanted`` (with other columns
    of its own). The outer explode keeps the optimizer from evaluating the shingles again in a filter below it."""
    words = docs.select("doc_id", "text_hash", split_words(F.col("text")).alias("words"))
    rows = words.select("doc_id", "text_hash", F.posexplode_outer(shingle_hashes(F.col("words"))).alias("at", "h"))
    return rows.join(wanted, "h")

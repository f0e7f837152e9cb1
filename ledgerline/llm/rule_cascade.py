"""Quality rules as a short-circuit cascade.

A sample tells what each rule costs (nanoseconds a document) and which share of documents it rejects; rules then run
in order of rejection per cost, and the first that rejects a document ends its cascade. The verdict is the
conjunction of all rules, so the order decides about time only, never about the result.

Base measures are taken of every whole text. The sample holds the SAMPLE documents with the smallest hash of their
id; it is used for the order alone, and a rule that reads base measures only costs next to nothing there.

Defined cases: a null or empty text has no words and fails the base rules; rows are judged one by one, so repeated
rows get the same verdict; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, read

SAMPLE = 256
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """A text with its measures, each taken when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.encode().split()  # splits at space and \t \n \v \f \r

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(c) for c in " \t\n\v\f\r")

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.text.count(c) for c in SYMBOLS)

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.encode().split()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def word_counts(self) -> Counter:
        return Counter(self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of 8 words which the text has twice or more. Windows are numbered exactly, from
        numbered halves."""
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, self.n_words)
        if len(number) == self.n_words:
            return 0
        width = 1
        while width < WINDOW:
            pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
            ids = np.unique(pairs, return_inverse=True)[1]
            width *= 2
        often = np.bincount(ids)[ids] > 1
        edge = np.zeros(self.n_words + 1, np.int64)
        starts = np.flatnonzero(often)
        edge[starts] += 1
        edge[starts + WINDOW] -= 1
        return int((np.cumsum(edge) > 0).sum())

    @cached_property
    def cased(self) -> tuple[int, int]:
        """Upper-case letters, and letters that have a case."""
        low, up = self.text.lower(), self.text.upper()
        if len(low) != len(self.text) or len(up) != len(self.text):  # a few letters change their length
            return sum(c.isupper() for c in self.text), sum(c.isupper() or c.islower() for c in self.text)
        codes = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (self.text, low, up)]
        return int((codes[0] != codes[1]).sum()), int((codes[1] != codes[2]).sum())

    def measured(self) -> Text:
        """The same text with the base measures and nothing else."""
        out = Text.__new__(Text)
        out.text, out.words = self.text, self.words
        for name in BASE:
            setattr(out, name, getattr(self, name))
        return out

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEATED * self.n_words


#: Rules by name: whether a text (that passed the base rules) is rejected.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "repeated_lines": lambda t: t.n_dup_lines > 2 and 10 * t.n_dup_lines > 3 * len(t.lines),
    "stutter": lambda t: 5 * sum(map(eq, t.words, t.words[1:])) > t.n_words,
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words,
    "shouting": lambda t: 2 * t.cased[0] > t.cased[1] > 0,
    "exclamations": lambda t: 10 * sum(w.endswith(b"!") for w in t.words) > 3 * t.n_words,
    "wordless": lambda t: 2 * sum(w.isalpha() or any(c > 127 or chr(c).isalpha() for c in w) for w in t.words) < t.n_words,
    "one_word": lambda t: 5 * max(t.word_counts.values()) > 2 * t.n_words,
}


def measure(spark: SparkSession, docs: DataFrame) -> list[tuple[str, float, float]]:
    """(rule, nanoseconds, share rejected) for every rule, from the sample. A rule is timed after the base measures, which every
    text gets anyway, but with nothing that another rule has measured."""
    ids = [r[0] for r in docs.select("doc_id").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(SAMPLE).collect()]
    names = list(RULES)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            out = []
            for text in b.column(0).to_pylist():
                base = Text(text)
                if base.base_failed:
                    continue
                for name in names:
                    t = base.measured()
                    began = time.perf_counter_ns()
                    bad = RULES[name](t)
                    out.append((name, float(time.perf_counter_ns() - began), float(bad)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))], names=["rule", "ns", "bad"])

    found = docs.filter(F.col("doc_id").isin(ids)).select("text").mapInArrow(probe, "rule string, ns double, bad double").groupBy("rule").agg(F.avg("ns"), F.avg("bad")).collect()
    return [tuple(r) for r in found]


def order(measured: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejection per cost; those that the sample says nothing about come last, by name."""
    worth = {name: bad / max(ns, 1.0) for name, ns, bad in measured}
    return sorted(RULES, key=lambda r: (-worth.get(r, 0.0), r))


def verdict(t: Text, rules: list[str]) -> str | None:
    """The first rule that rejects the text."""
    return next((r for r in rules if RULES[r](t)), None)


def judge(docs: DataFrame, rules: list[str]) -> DataFrame:
    """(doc_id, text) with the base measures, base_failed, kept and the rule that rejected the text (base: the base
    rules; null: kept)."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            rows = []
            for text in b.column(1).to_pylist():
                t = Text(text)
                failed = t.base_failed
                why = "base" if failed else verdict(t, rules)
                rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, why is None, why))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


def op5_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, order(measure(spark, docs))).drop("rejected_by")  # which rule was first depends on the order


ORACLE_OP5 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
u AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM w)),
r AS (SELECT doc_id, i FROM u QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
p AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS k FROM r) GROUP BY doc_id),
b AS (SELECT w.doc_id, w, t, lines, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN p ON p.doc_id = w.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed
  OR 10 * n_symbols > n_words
  OR n_dup_lines > 2 AND 10 * n_dup_lines > 3 * len(lines)
  OR 5 * len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) > n_words
  OR NOT word_chars BETWEEN 2 * n_words AND 15 * n_words
  OR 2 * len(regexp_extract_all(t, '\\p{Lu}')) > len(regexp_extract_all(t, '[\\p{Lu}\\p{Ll}]')) AND len(regexp_extract_all(t, '[\\p{Lu}\\p{Ll}]')) > 0
  OR 10 * len(list_filter(w, lambda x: ends_with(x, '!'))) > 3 * n_words
  OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) < n_words
  OR 5 * list_max(map_values(list_histogram(w))) > 2 * n_words) AS kept
FROM f
"""

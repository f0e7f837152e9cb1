"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, trained by FTRL with
an elastic-net penalty, then calibrated by temperature.

Features of a whole text: one to three characters of its lower-cased words (runs of letters, with the marks that stand on
them), with the spaces between, hashed into 2 ** BITS places; counts times inverse document frequency, scaled to length
1. Document frequencies are of all documents that may be learned from. A text is scored from the weights of the places
that it has.

The model itself is fitted on the driver from a bounded sample of them: about PER_LANGUAGE documents of each language, or
an equal share of SAMPLE if the languages are many, drawn by a hash of the id, SAMPLE_BYTES of text in all (no text is
cut: fewer are drawn, and one above a sixteenth of that is not drawn). Each comes with a snippet of it, so that short
texts are known too. A fifth of the sample sets the temperature, so that a score is the share of predictions of that
score that are right. The model has 2 ** BITS weights a language.

Whether a text is of a learned language at all is another question, which the probabilities cannot answer: they add up
to 1 for any text. ``strangeness`` asks how rare its n-grams are: the mean inverse document frequency of its n-grams, in
standard deviations of the learned texts of its length. ``usual`` is MARGIN times what USUAL of the held part of the sample
stay below, so that a few mislabelled texts do not move it; beyond it, the score falls off fast with the excess.

Defined cases: a null text and one without a letter are ``und`` with score 0; a language without documents to learn
from is never predicted; without any, every text is ``und``; ties go to the language first by name; an empty table
gives no rows; repeated rows get equal predictions; a null ``lang`` is not learned from; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_texts, id_crc, parts, read, small_or_not
from .ftrl import Ftrl, probabilities, temperature

BITS = 15
SIZE = 1 << BITS
PER_LANGUAGE, SAMPLE, SAMPLE_BYTES = 800, 40_000, 256 << 20
SNIPPET = 60
EPOCHS = 2
USUAL, MARGIN = 0.99, 2.0  # the share of the sample that is taken to be what its labels say, and what other texts may exceed it by
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(64 - BITS)


@dataclass
class Model:
    names: list[str]
    idf: np.ndarray
    w: np.ndarray
    b: np.ndarray
    t: float = 1.0
    mean: float = 0.0  # of the mean inverse document frequency of a text's n-grams
    between: float = 1.0  # its variance over texts
    within: float = 0.0  # and over a text's n-grams
    usual: float = float("inf")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point: 2 for a letter, 1 for a mark, else 0."""
    first = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    return np.array([2 if x == "L" else x == "M" for x in first], np.uint8)


def grams(text: str | None) -> np.ndarray | None:
    """Places of a text's n-grams, with repeats; None if it has no letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    kind = _kinds()[c]
    if not (kind == 2).any():
        return None
    inside = kind > 0
    after = np.concatenate([[False], inside[:-1]])
    c = np.concatenate([[np.uint64(32)], np.where(inside, c, np.uint64(32))[inside | after], np.full(int(inside[-1]), np.uint64(32))])
    two = c[:-1] << np.uint64(21) | c[1:]
    three = two[:-1] << np.uint64(21) | c[2:]
    return (np.concatenate([c, two, three]) * _MIX >> _TOP).astype(np.int64)


def sparse(places: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that occur, and their values, of length 1 together."""
    n = np.bincount(places, minlength=SIZE)
    at = np.flatnonzero(n)
    v = n[at] * idf[at]
    return at, v / np.sqrt(v @ v)


def strangeness(places: np.ndarray, model: Model) -> float:
    """How far the text's n-grams are from those that the learned texts have."""
    return float((model.idf[places].mean() - model.mean) / np.sqrt(model.between + model.within / len(places) + 1e-9))


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each place occurs, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(SIZE + 1, np.int64), 0
        for b in parts(batches):
            for text in b.column(0).to_pylist():
                if (g := grams(text)) is not None:
                    hit = np.zeros(SIZE + 1, bool)
                    hit[g] = True
                    df += hit
                    n += 1
        df[SIZE] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["place", "df"])

    out, n = np.zeros(SIZE, np.int64), 0
    for place, df in docs.select("text").mapInArrow(run, "place long, df long").groupBy("place").agg(F.sum("df")).collect():  # SIZE + 1 rows at most
        if place == SIZE:
            n = df
        else:
            out[place] = df
    return out, n


def fit(rows: list[tuple[str, str]], df: np.ndarray, n: int) -> Model:
    """rows: (text, language) in random order."""
    names = sorted({lang for _, lang in rows})
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    learner = Ftrl(SIZE, len(names), alpha=0.5, l1=1e-3, l2=1e-3)
    number = {x: i for i, x in enumerate(names)}
    held: list[tuple[tuple[np.ndarray, np.ndarray], int, np.ndarray]] = []
    ready: list[tuple[tuple[np.ndarray, np.ndarray], int]] = []
    rarity = []  # of the whole texts that are learned: mean, variance, number of n-grams
    for i, (text, lang) in enumerate(rows):
        start = (i * 7919) % max(1, len(text) - SNIPPET)
        for whole, part in ((True, text), (False, text[start : start + SNIPPET])):
            if (g := grams(part)) is None:
                continue
            if i % 5 == 4:
                held.append((sparse(g, idf), number[lang], g))
            else:
                ready.append((sparse(g, idf), number[lang]))
                if whole:
                    rarity.append((idf[g].mean(dtype=float), idf[g].var(dtype=float), len(g)))
    if len(names) > 1:
        for _ in range(EPOCHS):
            for row, label in ready:
                learner.learn(row, label)
    model = Model(names, idf, *learner.fitted())
    if held and len(names) > 1:
        model.t = temperature(np.array([x @ model.w[at] + model.b for (at, x), _, _ in held]), np.array([y for _, y, _ in held]))
    if rarity and held:
        mean, variance, size = np.array(rarity).T
        # neighbouring n-grams share characters: the variance of a text's mean is three times that of independent ones
        model.mean, model.within = float(mean.mean()), 3 * float(variance.mean())
        model.between = max(1e-4, float(mean.var() - (model.within / size).mean()))
        model.usual = MARGIN * max(1.0, float(np.quantile([strangeness(g, model) for _, _, g in held], USUAL)))
    return model


def predict(text: str | None, model: Model) -> tuple[str, float]:
    """The language, and how likely it is right. A text unlike all that was learned scores low, whatever it is nearest to."""
    if not model.names or (g := grams(text)) is None:
        return "und", 0.0
    best, score = 0, 1.0
    if len(model.names) > 1:
        at, x = sparse(g, model.idf)
        p = probabilities((x @ model.w[at] + model.b).astype(np.float64) / model.t)
        best = int(p.argmax())
        score = float(p[best])
    excess = strangeness(g, model) / model.usual
    return model.names[best], score if excess <= 1 else score * float(np.exp(1 - excess**2))


def learn(docs: DataFrame, learns: Column) -> Model:
    """A model of the languages of ``docs`` (doc_id, text, lang), from rows that ``learns`` allows."""
    known = docs.filter(learns & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes, n = small_or_not(known.groupBy("lang").agg(F.count("*").alias("of_lang")), SAMPLE)
    if not n:
        return Model([], np.zeros(SIZE, np.float32), np.zeros((SIZE, 0), np.float32), np.zeros(0, np.float32))
    u = F.shiftrightunsigned(F.xxhash64(F.lit("language"), F.col("doc_id").cast("string")), 11) / float(2**53)
    share = min(PER_LANGUAGE, SAMPLE / n)
    drawn = known.join(sizes, "lang").filter(u < F.least(F.lit(1.0), share / F.col("of_lang")))
    # in an order that has nothing to do with the draw: by u, the rare languages would come last
    order = F.xxhash64(F.lit("order"), F.col("doc_id").cast("string"), F.col("lang"), F.col("text"))
    rows = bounded_texts(drawn.select("text", "lang", order.alias("at")), "at", 2 * SAMPLE, SAMPLE_BYTES)
    return fit([(r.text, r.lang) for r in rows], *document_frequency(known))


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score for the text, the last column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size but for the number of languages in the sample
    slim = docs.select(*keep, "text")
    fields = [f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            found = [predict(t, sent.value) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*keep, "lang_pred", "score"])

    return slim.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """``docs`` without the documents that have no language or one of less certainty than ``least``; a null ``lang`` of
    those that stay becomes the prediction."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    at, lang = docs.columns.index("text"), docs.columns.index("lang")
    slim = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            found = [predict(t, sent.value) for t in b.column(at).to_pylist()]
            columns = b.columns
            columns[lang] = pa.array([x[0] if old is None else old for old, x in zip(columns[lang].to_pylist(), found, strict=True)], columns[lang].type)
            good = pa.array([x[0] != "und" and x[1] >= least for x in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(good)

    return slim.mapInArrow(run, slim.schema).toDF(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_crc(F.col("doc_id")) % 3 == 1
    model = learn(docs, ~held_out)
    return identify(docs.withColumn("held_out", held_out), model, ("doc_id", "held_out"))

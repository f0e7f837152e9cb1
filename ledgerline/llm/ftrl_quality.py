"""Quality scores: logistic regression on hashed word n-grams, trained by FTRL, scored as sparse dot products.

Features of a whole text: sequences of one to three tokens, hashed into 2 ** BITS signed places. Tokens are runs of
letters and digits, as they are written, and runs of other marks; a token equal to the one before it is the token AGAIN, so that
stuttering is one sequence whatever is repeated. The sequences of a length weigh together 1, so texts of any length
compare.

The model is fitted on the driver from at most SAMPLE labelled documents, those with the smallest hash of their id
(``labels`` names the rows; the fold that is held out is never read for it), and from SAMPLE_BYTES of text at most: fewer
are drawn if they are long, none is cut, and one above a sixteenth of that is not drawn. Scoring is over all documents.

Defined cases: a null text is empty; an empty text is scored by the bias and the place of emptiness; a document with
several labels counts with their mean (0.5 and above: 1), one with several rows with the first text; without any
label, or with one class only, every score is 0.5; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_texts, id_crc, parts, read
from .ftrl import Ftrl, Row, probabilities

BITS, LENGTHS = 20, 3
SIZE = 1 << BITS
SAMPLE, SAMPLE_BYTES, EPOCHS = 6000, 128 << 20, 4
CUT = 0.3
MEMORY = 1 << 18  # words whose tokens a task remembers
AGAIN = np.uint64(0x5851F42D4C957F2D)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Memory(dict):
    """word: the hashes of its tokens; starts anew when full."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = found = tuple(xxhash.xxh64_intdigest(t) for t in _TOKEN.findall(word.decode("utf-8", "replace")))
        return found


def features(text: str | None, memory: Memory) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and signs of the sequences of a whole text, with repeats, by length."""
    h = np.fromiter(chain.from_iterable(map(memory.__getitem__, (text or "").encode().split())), np.uint64)
    if not len(h):
        return [(np.array([0]), np.array([1.0]))]
    token = h.copy()
    token[1:][h[1:] == h[:-1]] = AGAIN
    out, gram = [], np.zeros(len(token) + 1, np.uint64)
    for _ in range(min(LENGTHS, len(token))):
        gram = (gram[:-1] ^ gram[:-1] >> np.uint64(29)) * _MIX + token[len(token) - len(gram) + 1 :]
        mixed = (gram ^ gram >> np.uint64(32)) * _MIX
        out.append(((mixed >> np.uint64(64 - BITS)).astype(np.int64), 1.0 - 2.0 * (mixed >> np.uint64(20) & np.uint64(1))))
    return out


def sparse(groups: list[tuple[np.ndarray, np.ndarray]]) -> Row:
    """The same as sorted indexes and values."""
    at = np.concatenate([g for g, _ in groups])
    x = np.concatenate([sign / len(g) for g, sign in groups])
    index, back = np.unique(at, return_inverse=True)
    return index, np.bincount(back, x)


def fit(rows: list[tuple[str | None, int]]) -> tuple[np.ndarray, float]:
    model, memory = Ftrl(SIZE, alpha=2.0, l1=1e-4, l2=1e-4), Memory()
    ready = [(sparse(features(text, memory)), label) for text, label in rows]
    if len({label for _, label in ready}) < 2:
        return np.zeros(SIZE, np.float32), 0.0
    for _ in range(EPOCHS):
        for row, label in ready:
            model.learn(row, label)
    w, b = model.fitted()
    return w[:, 0], float(b[0])


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """(doc_id, held_out, text) with score: the dot product of a text's sparse features and the weights, as a probability."""
    key = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (w, b), memory = sent.value, Memory()
        for batch in parts(batches):
            logits = [b + sum(float((w[g] * sign).mean()) for g, sign in features(t, memory)) for t in batch.column(2).to_pylist()]
            p = [float(probabilities(np.array([x]))[0]) for x in logits]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array([int(x >= CUT) for x in p], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {key}, held_out boolean, score double, predicted int")


def sample(docs: DataFrame, labels: DataFrame, learns: Column, label: str, most: int = SAMPLE) -> list[tuple[str | None, int]]:
    """At most ``most`` (text, 0 or 1) of the labelled rows that ``learns`` allows, in order of a hash of the id."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    marked = labels.filter(learns & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    few = F.broadcast(marked.orderBy(order, "doc_id").limit(most))
    texts = docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return [(r.text, r.y) for r in bounded_texts(texts.withColumn("at", order), "at", most, SAMPLE_BYTES)]


def op1_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_crc(F.col("doc_id")) % 5 == 0
    rows = sample(docs, read(spark, sf_dir, "labels"), ~held_out, "quality")
    return score(docs.withColumn("held_out", held_out), *fit(rows))

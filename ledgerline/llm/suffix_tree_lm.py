"""Language-model scores by a probabilistic suffix tree over words.

Symbols are the lower-cased words of a text and its end. A text stands between two ends, and a context is what stands
before a symbol, DEPTH symbols at most.

The empty context gives each seen word its discounted relative frequency. What the discount frees belongs to the words
that the training texts do not have: it is shared equally among as many as there are by Chao's estimate (n1 ** 2 / 2 n2,
from the words seen once and twice), so that a new word costs about as much as a word seen once, or more.

A sequence (context and next symbol) counts if it occurs LEAST times in the training texts, whatever their size, and so
do both sequences one shorter that it begins and ends with. A context becomes a state of the tree if its next-symbol
distribution diverges from that of its suffix by MIN_KL nats a symbol and MIN_GAIN in all. A state's distribution is
smoothed: sequences that count have their discounted relative frequency, and what is left goes to the other symbols in
proportion to the distribution of the longest shorter state. A symbol is scored by the longest state that is a suffix of
what stands before it. Every distribution adds up to 1.

The tree is never in one place, since it grows with the corpus. Texts are cut into chunks of about CHUNK symbols, kept
as numbers. A chunk asks about each of its sequences once, by a 64-bit key: keys go to as many buckets as the corpus
needs, a bucket adds up what all chunks say and answers each of them. So a sequence that every text has is one row a chunk,
not one an occurrence, and no key is hot. Round by round a chunk learns how often its words, pairs, triples and so on
occur in all training texts; one chunk of those that have a sequence adds its term to the divergence of its
context, and chunks ask again which contexts are states. Nothing but counts of words reaches the driver.

Defined cases: a null text is empty and consists of its end; with nothing to learn from, every symbol has probability 1;
rows are scored one by one, repeated or not; an empty table gives no rows; a text longer than CHUNK is a chunk of its
own; other columns are not read. Keys stand for words and sequences: two that share 64 bits would count as one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Bucketed, Staged, id_crc, parts, read, short_lived_shuffles

DEPTH = 3
LEAST = 2
SEQ_SHARE = 0.0  # a sequence needs no share of all symbols: LEAST alone decides, at every size
MIN_KL, MIN_GAIN = 0.005, 10.0
DISCOUNT = 0.5
END = b"\n"  # no word has this byte
CHUNK = 1 << 20  # symbols
BUCKET = 1 << 21  # symbols of the corpus for each bucket of keys
BUCKETS = 64  # at least
CHUNKS_A_TASK, CHUNKS_A_FILE = 2, 8
STATES = 100  # step of a question for states of a level, above those for counts
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Root:
    """The empty context; c = 0 is an unseen word, one of ``unseen``."""

    n: int
    v: int
    discount: float
    unseen: float = 1.0

    def logp(self, c: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(c))
        return np.log10(np.where(c > 0, c - self.discount, self.discount * self.v / self.unseen) / self.n)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))


# --- numbers as bytes -----------------------------------------------------------------------------------------------


def packed(x: np.ndarray) -> bytes:
    """Unsigned numbers by planes of bytes, the lowest first; planes above the largest number are left out, and those
    that are mostly zero compress well."""
    x = np.ascontiguousarray(x, np.uint64)
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return bytes([width]) + np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n and data[0]:
        out[:, : data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n).T
    return out.reshape(-1).view(np.uint64)


def squeezed(x: np.ndarray) -> bytes:
    """The same, compressed, for numbers most of which are equal or small."""
    raw = packed(x)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    return unpacked(pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True), n)


def blocks(*parts_: bytes) -> bytes:
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts_)


def unblocked(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def steps_of(places: np.ndarray) -> bytes:
    """Places in order, as the steps between them."""
    return squeezed(np.diff(places, prepend=0))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _MIX2
    return x ^ x >> np.uint64(29)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As np.unique with return_index and return_inverse, which sorts in a slower way for the sake of the first places."""
    order = np.argsort(x)
    x = x[order]
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    starts = np.flatnonzero(new)
    number = np.empty(len(x), np.int64)
    number[order] = np.cumsum(new) - 1
    return x[starts], np.minimum.reduceat(order, starts) if len(x) else order, number


def distinct_pairs(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, key: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """distinct(key(all places)) for keys of pairs (a below n_a, b below n_b). Pairs are sorted with their places in one number each,
    where that fits, and keys are made of the first places alone."""
    n, of_b, of_place = len(a), n_b.bit_length(), len(a).bit_length()
    if n and n_a.bit_length() + of_b + of_place <= 64:
        both = a.astype(np.uint64) << np.uint64(of_b) | b.astype(np.uint64)
        both = both << np.uint64(of_place) | np.arange(n, dtype=np.uint64)
        both.sort()
        places = (both & np.uint64((1 << of_place) - 1)).astype(np.int64)
        both >>= np.uint64(of_place)
        new = np.ones(n, bool)
        new[1:] = both[1:] != both[:-1]
        first = places[new]
        keys = key(first)
        order = np.argsort(keys)
        keys = keys[order]
        if not (keys[1:] == keys[:-1]).any():
            rank = np.empty(len(keys), np.int64)
            rank[order] = np.arange(len(keys))
            number = np.empty(n, np.int64)
            number[places] = rank[np.cumsum(new) - 1]
            return keys, first[order], number
    return distinct(key(np.arange(n)))


# --- chunks ---------------------------------------------------------------------------------------------------------


NUMBERS = ("chunk", "words", "times", "n_words", "ids", "n_ids", "sizes", "learns")


def chunks(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(NUMBERS, kept) of docs (keep, text, learns): the distinct words of some texts as keys in order, how often each occurs,
    each symbol's rank among them by that, how many symbols each text has, whether it is learned from."""
    k = len(keep)
    inner = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, end = xxhash.xxh64_intdigest, xxhash.xxh64_intdigest(END)
        hashes: list[np.ndarray] = []
        sizes: list[int] = []
        learned: list[bool] = []
        rows: list[pa.RecordBatch] = []
        held, number = 0, TaskContext.get().partitionId() << 32

        def cut() -> pa.RecordBatch:
            nonlocal held, number
            words, ids = np.unique(np.concatenate(hashes), return_inverse=True)
            kept = pa.concat_arrays([pa.StructArray.from_arrays(b.columns[:k], names=list(keep)) for b in rows])
            one = lambda x, kind: pa.array([x], kind)
            times = np.bincount(ids, minlength=len(words))
            rank = np.empty(len(words), np.int64)
            rank[np.argsort(-times, kind="stable")] = np.arange(len(words))  # frequent words get small numbers, which compress
            cols = [one(number, pa.int64()), one(packed(np.diff(words, prepend=np.uint64(0))), pa.binary()), one(squeezed(times), pa.binary()), one(len(words), pa.int64()), one(squeezed(rank[ids]), pa.binary()), one(len(ids), pa.int64()), one(packed(np.array(sizes)), pa.binary()), one(np.array(learned, bool).tobytes(), pa.binary())]
            cols.append(pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept))
            for x in (hashes, sizes, learned, rows):
                x.clear()
            held, number = 0, number + 1
            return pa.RecordBatch.from_arrays(cols, names=[*NUMBERS, "kept"])

        for b in parts(batches, 200):
            for text, learns in zip(b.column(k).to_pylist(), b.column(k + 1).to_pylist(), strict=True):
                found = (text or b"").lower().split()
                ids = np.empty(len(found) + 2, np.uint64)
                ids[0] = ids[-1] = end
                ids[1:-1] = np.fromiter(map(digest, found), np.uint64, len(found))
                hashes.append(ids)
                sizes.append(len(ids))
                learned.append(bool(learns))
                held += len(ids)
            rows.append(b)
            if held >= CHUNK:
                yield cut()
        if rows:
            yield cut()

    shape = f"chunk long, words binary, times binary, n_words long, ids binary, n_ids long, sizes binary, learns binary, kept array<struct<{inner}>>"
    return docs.select(*keep, F.col("text").cast("binary").alias("text"), "learns").mapInArrow(run, shape)


@dataclass
class Level:
    """The sequences of one length in a chunk, by their keys in order: where they occur, how often in all training
    texts (``count``, 0 below LEAST), whether this chunk speaks for them, and the numbers of the
    sequences one shorter that they begin and end with. ``at``: for each place the number of the one that ends there and counts, or -1."""

    keys: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    places: np.ndarray
    number: np.ndarray
    count: np.ndarray | None = None
    speaks: np.ndarray | None = None
    at: np.ndarray | None = None
    state: np.ndarray | None = None
    back: np.ndarray | None = None
    logp: np.ndarray | None = None


class Chunk:
    """A chunk with what it has been told: answers by step, in the order of the keys it asked for."""

    def __init__(self, row: dict, answers: dict[int, list[tuple[int, bytes]]], root: Root | None):
        self.root = root
        self.answers = answers
        self.words = np.cumsum(unpacked(row["words"], row["n_words"]), dtype=np.uint64)
        learns = np.frombuffer(row["learns"], bool)
        self.sizes = unpacked(row["sizes"], len(learns)).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        by_rank = np.argsort(-unsqueezed(row["times"], row["n_words"]).astype(np.int64), kind="stable")
        self.ids = by_rank[unsqueezed(row["ids"], row["n_ids"]).astype(np.int64)]
        self.learns = np.repeat(learns, self.sizes)
        self.inner = np.ones(len(self.ids), bool)
        self.inner[self.starts] = False
        self.levels: list[Level] = []
        none = np.zeros(0, np.int64)
        self.grow(Level(self.words, none, none, np.arange(len(self.ids)), self.ids))
        while len(self.levels) - 1 in answers and len(self.levels) <= DEPTH:
            self.grow(self.longer())

    def grow(self, level: Level) -> None:
        k = len(self.levels)
        self.levels.append(level)
        if k not in self.answers:
            return
        told = np.concatenate([np.zeros(0, np.uint64), *[unsqueezed(x, n) for n, x in self.answers[k]]])
        level.count, level.speaks = (told >> np.uint64(1)).astype(np.int64), (told & np.uint64(1)).astype(bool)
        level.at = np.full(len(self.ids), -1)
        level.at[level.places] = np.where(level.count >= LEAST, np.arange(len(level.keys)), -1)[level.number]
        if k == 0:
            if self.root is None:
                return
            level.logp = self.root.logp(level.count)
        else:
            shorter = self.levels[k - 1]
            if shorter.state is None:
                return
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.log10((level.count - DISCOUNT) / shorter.count[level.begins])
            level.logp = np.where(shorter.state[level.begins], p, shorter.logp[level.ends])
        if STATES + k in self.answers:
            counts = np.flatnonzero(level.count >= LEAST)
            level.state, level.back = np.zeros(len(level.keys), bool), np.zeros(len(level.keys))
            first = 0
            for n, told in self.answers[STATES + k]:
                at, back = unblocked(told)
                back = np.frombuffer(back, np.float32)
                states = counts[first + np.cumsum(unsqueezed(at, len(back)).astype(np.int64))]
                level.state[states], level.back[states] = True, back
                first += n

    def own(self, k: int) -> np.ndarray:
        """How often each sequence of level k occurs in the chunk's training texts."""
        level = self.levels[k]
        return np.bincount(level.number, (self.learns & self.inner)[level.places], len(level.keys)).astype(np.uint64)

    def longer(self) -> Level:
        """The sequences one longer than those of the last level of which both shorter parts count."""
        last = self.levels[-1]
        before = np.concatenate([[-1], last.at[:-1]])
        places = np.flatnonzero((last.at >= 0) & (before >= 0) & self.inner)
        begins, ids = before[places], self.ids[places]
        key = lambda at: _mixed(last.keys[begins[at]] * _MIX + self.words[ids[at]])
        keys, first, number = distinct_pairs(begins, ids, len(last.keys), len(self.words), key)
        return Level(keys, begins[first], last.at[places[first]], places, number)

    def terms(self, k: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Keys of the contexts of level k that count; the places among them of those that this chunk speaks for a sequence of;
        and of these, how many sequences it speaks for, how often they occur in all, how often the context does, and the sums
        of q and p ln(p / q) over the symbols that follow it."""
        level, longer = self.levels[k], self.levels[k + 1]
        told = np.flatnonzero(longer.speaks & (longer.count >= LEAST))
        begins, n = longer.begins[told], longer.count[told]
        p = (n - DISCOUNT) / level.count[begins]
        q = 10.0 ** level.logp[longer.ends[told]]
        kinds, often, q_sum, kl = (np.bincount(begins, x, len(level.keys)) for x in (np.ones(len(told)), n, q, p * np.log(p / q)))
        counts = np.flatnonzero(level.count >= LEAST)
        at = np.flatnonzero(kinds[counts])
        own = counts[at]
        return level.keys[counts], at, (kinds[own].astype(np.uint64), often[own].astype(np.uint64), level.count[own].astype(np.uint64), q_sum[own], kl[own].astype(np.float32))

    def scores(self) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        words = self.levels[0]
        c = words.count
        logp = words.logp[self.ids]
        todo = self.inner.copy()
        for k in range(min(DEPTH, len(self.levels) - 1), -1, -1):
            level = self.levels[k]
            if level.state is None:
                continue
            context = np.concatenate([[-1], level.at[:-1]])
            at = np.flatnonzero(todo & (context >= 0))
            at = at[level.state[context[at]]]
            if not len(at):
                continue
            whole = self.levels[k + 1].at[at] if k + 1 < len(self.levels) else np.full(len(at), -1)
            hit = at[whole >= 0]
            if len(hit):
                logp[hit] += self.levels[k + 1].logp[whole[whole >= 0]] - words.logp[self.ids[hit]]
                todo[hit] = False
            miss = at[whole < 0]
            logp[miss] += level.back[context[miss]]
        total = lambda x: np.add.reduceat(np.where(self.inner, x, 0), self.starts)
        return [self.sizes - 1, total((c > 0)[self.ids].astype(np.int64)), total(self.root.base(c)[self.ids]), total(logp)]


# --- questions and answers ------------------------------------------------------------------------------------------

ASKED = "step int, bucket long, chunk long, n long, keys binary, says binary"
TOLD = "step int, chunk long, bucket long, n long, says binary, stats array<double>"


def questions(step: int, chunk: int, keys: np.ndarray, bits: int, says: Callable[[int, int], bytes]) -> Iterator[tuple]:
    """Keys in order, by bucket: the bits at their top; with what is said about those from one place to another."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    edges = [0, *cuts.tolist(), len(keys)]
    for bucket, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            yield step, bucket, chunk, b - a, packed(np.diff(keys[a:b], prepend=np.uint64(0))), says(a, b)


def answer(table: pa.Table) -> pa.Table:
    """What all chunks together say about the keys of one bucket, for each chunk in the order of its keys."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    step = rows[0]["step"]
    keys, first, number = distinct(np.concatenate([np.cumsum(unpacked(r["keys"], r["n"]), dtype=np.uint64) for r in rows]))
    starts = np.cumsum([0, *[r["n"] for r in rows]])
    stats = None
    if step < STATES:
        total = np.bincount(number, np.concatenate([unsqueezed(r["says"], r["n"]) for r in rows]).astype(float), len(keys)).astype(np.uint64)
        if step == 0:
            stats = [float(x) for x in (total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum())]
        else:
            total[total < LEAST] = 0
        told = total[number] << np.uint64(1)
        told[first] |= np.uint64(1)
        tell = lambda a, b: squeezed(told[a:b])
    else:
        kinds, often, c, q, kl = (np.zeros(len(keys)) for _ in range(5))
        for r, start in zip(rows, starts, strict=False):
            *whole, q_sum, part = unblocked(r["says"])
            part = np.frombuffer(part, np.float32)
            at, n_kinds, n, of = (unsqueezed(x, len(part)).astype(np.int64) for x in whole)
            at = number[start + np.cumsum(at)]  # a chunk has a key once
            kinds[at] += n_kinds
            often[at] += n
            c[at] = of
            q[at] += np.frombuffer(q_sum, np.float64)
            kl[at] += part
        p_left = np.maximum(1 - (often - DISCOUNT * kinds) / np.maximum(c, 1), 1e-9)
        q_left = np.maximum(1 - q, 1e-9)
        kl += p_left * np.log(p_left / q_left)
        state = ((kl >= MIN_KL) & (kl * c >= MIN_GAIN))[number]
        back = np.log10(p_left / q_left).astype(np.float32)[number]

        def tell(a: int, b: int) -> bytes:
            at = np.flatnonzero(state[a:b])
            return blocks(steps_of(at), back[a:b][at].tobytes())

    kinds_ = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.float64()))
    out = [(step, r["chunk"], r["bucket"], r["n"], tell(a, a + r["n"]), None if a else stats) for r, a in zip(rows, starts.tolist(), strict=False)]
    return pa.Table.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds_)], names=["step", "chunk", "bucket", "n", "says", "stats"])


def told_of(rows: list[dict], steps: list[int]) -> dict[int, list[tuple[int, bytes]]]:
    """Answers by step, in the order of the buckets, with the number of keys; a chunk may have asked nothing in a step."""
    out: dict[int, list[tuple[int, bytes]]] = {s: [] for s in steps}
    for r in sorted(rows, key=lambda r: (r["step"], r["bucket"])):
        out[r["step"]].append((r["n"], r["says"]))
    return out


class Tree:
    """The rounds of questions over staged chunks."""

    def __init__(self, staged: Staged, n_chunks: int, symbols: int):
        # in buckets by chunk, so that in every round only the answers are shuffled to the chunks
        self.held = Bucketed(staged.df, "lm-chunks-dealt", "chunk", max(1, -(-n_chunks // CHUNKS_A_TASK)))
        staged.drop()
        self.bits = max(BUCKETS, -(-symbols // BUCKET)).bit_length() - 1
        self.told: list[Staged] = []
        self.steps: list[int] = []
        self.root: Root | None = None

    def answers(self) -> DataFrame:
        out = self.told[0].df
        for x in self.told[1:]:
            out = out.unionByName(x.df)
        return out.drop("stats")

    def ask(self, counts: int, states: int | None) -> None:
        """Asks for the counts of level ``counts`` (up to DEPTH) and for the states of level ``states``."""
        bits, root, steps = self.bits, self.root, list(self.steps)

        def about(row: dict, answers: list[dict]) -> pa.Table:
            c = Chunk(row, told_of(answers, steps), root)
            out = []
            if counts <= DEPTH:
                of_chunk = c.own(counts)
                out += questions(counts, row["chunk"], c.levels[counts].keys, bits, lambda a, b: squeezed(of_chunk[a:b]))
            if states is not None:
                keys, at, own = c.terms(states)

                def says(a: int, b: int) -> bytes:
                    i, j = np.searchsorted(at, (a, b))
                    *whole, q, kl = (x[i:j] for x in own)
                    return blocks(steps_of(at[i:j] - a), *map(squeezed, whole), q.tobytes(), kl.tobytes())

                out += questions(STATES + states, row["chunk"], keys, bits, says)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.Table.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["step", "bucket", "chunk", "n", "keys", "says"])

        asked = self.each(about, ASKED, NUMBERS)
        self.told.append(Staged(asked.groupBy("step", "bucket").applyInArrow(answer, TOLD), f"lm-told-{counts}"))
        self.steps += [counts] * (counts <= DEPTH) + ([] if states is None else [STATES + states])

    def each(self, about, shape: str, columns: tuple[str, ...]) -> DataFrame:
        """``about(chunk's row, its answers)`` for every chunk."""
        slim = self.held.df.select(*columns)
        if not self.told:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in parts(batches, 1):
                    yield from about(b.to_pylist()[0], []).to_batches()

            return slim.mapInArrow(run, shape)

        def both(left: pa.Table, right: pa.Table) -> pa.Table:
            # a chunk's row stays an Arrow table up to here, so that what it keeps is never turned into Python objects
            row = left.drop_columns(["kept"]).to_pylist()[0] if "kept" in left.column_names else left.to_pylist()[0]
            return about(row | ({"kept": left["kept"]} if "kept" in left.column_names else {}), right.to_pylist())

        return slim.groupBy("chunk").cogroup(self.answers().groupBy("chunk")).applyInArrow(both, shape)

    def learn(self) -> None:
        self.ask(0, None)
        n, v, n1, n2 = (int(x or 0) for x in self.told[0].df.filter("stats IS NOT NULL").agg(*[F.sum(F.col("stats")[i]) for i in range(4)]).first())
        discount = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else DISCOUNT
        self.root = Root(n, v, discount, max(1.0, n1 * n1 / (2 * max(n2, 1))))
        for k in range(1, DEPTH + 1):
            self.ask(k, k - 2 if k > 1 else None)
        self.ask(DEPTH + 1, DEPTH - 1)


def scores(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``docs`` (with text and learns) with n_tokens, n_known, train_tokens, base_score, score."""
    names = [f"k{i}" for i in range(len(keep))]  # whatever the kept columns are called
    slim = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(keep, names, strict=True)], "text", "learns")
    staged = Staged(chunks(slim.withColumn("row", F.lit(True)), (*names, "row")), "lm-chunks", CHUNKS_A_FILE)
    n_chunks, symbols = staged.df.agg(F.count("*"), F.sum("n_ids")).first()
    with short_lived_shuffles(docs.sparkSession):
        return _scored(slim, keep, names, Tree(staged, n_chunks, symbols or 0))


def _scored(slim: DataFrame, keep: tuple[str, ...], names: list[str], tree: Tree) -> DataFrame:
    tree.learn()
    root, steps = tree.root, list(tree.steps)
    fields = [f"{x} {slim.schema[x].dataType.simpleString()}" for x in names]

    def rated(row: dict, answers: list[dict]) -> pa.Table:
        c = Chunk(row, told_of(answers, steps), root)
        kept = pa.concat_arrays([x for x in row["kept"].chunks]).flatten()
        tokens, known, base, score = c.scores()
        cols = [*[kept.field(i) for i in range(len(names))], pa.array(tokens), pa.array(known), pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(cols, names=[*names, "n_tokens", "n_known", "base_score", "score"])

    shape = ", ".join([*fields, "n_tokens long, n_known long, base_score double, score double"])
    out = Staged(tree.each(rated, shape, (*NUMBERS, "kept")), "lm-scores").df
    for x in (*tree.told, tree.held):
        x.drop()
    return out.select(*[F.col(x).alias(c) for x, c in zip(names, keep, strict=True)], "n_tokens", "n_known", F.lit(root.n).cast("long").alias("train_tokens"), "base_score", "score")


def op10_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_crc(F.col("doc_id")) % 7 == 2
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return scores(docs.withColumn("learns", ~F.col("held_out")), ("doc_id", "held_out"))

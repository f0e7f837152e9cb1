"""Joining texts with rules: patterns, substrings, suffixes, word sets.

Rule tables are dimension tables given by the caller; they are compiled into literal patterns, one expression a rule,
so a text is scanned in one projection without a join and nothing is compiled for a row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """An entity with patterns of which any must and none may be found. A pattern's group ``group`` is the span that
    counts, the whole match by default."""

    entity: str
    any: tuple[str, ...]
    none: tuple[str, ...] = ()
    scope: tuple[str, ...] = ()
    group: int = 0


def _span(hay: Column, rule: Rule) -> Column:
    longest = lambda p: F.coalesce(F.array_max(F.transform(F.regexp_extract_all(hay, F.lit(p), F.lit(rule.group)), lambda m: F.length(m))), F.lit(0))
    spans = [longest(p) for p in rule.any]
    best = F.greatest(*spans) if len(spans) > 1 else spans[0]
    for p in rule.none:
        best = F.when(hay.rlike(p), 0).otherwise(best)
    return best


def hits(hay: Column, rules: list[Rule], scope: Column | None = None) -> Column:
    """Entities whose longest span is the longest of all rules', in order; empty if none matches. A rule with a scope
    is asked only where ``scope`` is one of it."""
    tried = []
    for r in rules:
        span = _span(hay, r)
        if r.scope and scope is not None:
            span = F.when(scope.isin(*r.scope), span).otherwise(0)
        tried.append(F.struct(span.alias("span"), F.lit(r.entity).alias("entity")))
    found = F.filter(F.array(*tried), lambda x: x["span"] > 0)
    top = F.array_max(F.transform(found, lambda x: x["span"]))
    return F.transform(found, lambda x: x), top


def match(df: DataFrame, hay: Column, rules: list[Rule], scope: Column | None = None, name: str = "hits") -> DataFrame:
    """``df`` with the entities that match best. The span arrays are computed once, in a projection of their own."""
    found, _ = hits(hay, rules, scope)
    x = df.withColumn("__found", found)
    x = x.withColumn("__top", F.array_max(F.transform("__found", lambda h: h["span"])))
    best = F.array_sort(F.array_distinct(F.transform(F.filter("__found", lambda h: h["span"] == F.col("__top")), lambda h: h["entity"])))
    return x.withColumn(name, best).drop("__found", "__top")


def match_any_scope(df: DataFrame, hay: Column, rules: list[Rule], named: Column, name: str = "hits") -> DataFrame:
    """For texts that speak for many scopes: the winners of each scope that the text names (an array), together."""
    scopes = sorted({s for r in rules for s in r.scope})
    parts = []
    x = df
    for i, s in enumerate(scopes):
        x = match(x, hay, [r for r in rules if s in r.scope], None, f"__s{i}")
        parts.append(F.when(F.array_contains(named, s), F.col(f"__s{i}")).otherwise(F.array().cast("array<string>")))
    return x.withColumn(name, F.array_sort(F.array_distinct(F.concat(*parts)))).drop(*[f"__s{i}" for i in range(len(scopes))])


def classify(df: DataFrame, found: str = "hits") -> DataFrame:
    """entity where one matched, ambiguous (all of them) where several did, and the state."""
    n = F.size(found)
    return df.withColumns({
        "entity": F.when(n == 1, F.get(F.col(found), F.lit(0))),
        "ambiguous": F.when(n > 1, F.col(found)),
        "state": F.when(n == 1, "matched").when(n > 1, "ambiguous").otherwise("unmatched"),
    })


def longest_key(text: Column, keys: list[tuple[str, str]], how: str = "contains") -> Column:
    """The value of the longest key that the text contains (or ends with); the first of equally long ones."""
    test = F.contains if how == "contains" else F.endswith
    ordered = sorted(keys, key=lambda k: -len(k[0]))
    out = reduce(lambda acc, k: F.when(test(text, F.lit(k[0])), k[1]) if acc is None else acc.when(test(text, F.lit(k[0])), k[1]), ordered, None)
    return out if out is not None else F.lit(None).cast("string")


def by_site(host: Column, path: Column, sites: list[tuple[str, str]]) -> Column:
    """The source of an address: sites are (host or host/path, source). A host counts for itself and for hosts below
    it; an exact host before others, then the longer site, then the greater name."""
    scored = []
    for site, source in sites:
        h, _, p = site.partition("/")
        fits = (host == h) | F.endswith(host, F.lit("." + h))
        if p:
            fits = fits & F.startswith(path, F.lit("/" + p))
        score = F.when(fits, F.when(host == h, 10_000).otherwise(0) + len(site)).otherwise(0)
        scored.append(F.struct(score.alias("score"), F.lit(source).alias("source")))
    best = F.array_max(F.array(*scored))
    return F.when(best["score"] > 0, best["source"])


def contains_all(title_words: Column, wanted: Column, least: int = 2) -> Column:
    """Whether a text has all of the words that tell an entity apart, ``least`` at least."""
    return (F.size(wanted) >= least) & (F.size(F.array_except(wanted, title_words)) == 0)


def idf(df: DataFrame, words: str, key: str) -> DataFrame:
    """(word, df, idf): the logarithm of rows over rows that have the word. Words are counted once a row."""
    n = df.agg(F.count("*").alias("n"))
    seen = df.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    return seen.join(F.broadcast(n)).select("word", "df", F.log(F.col("n") / F.col("df")).alias("idf"))


def similar(left: DataFrame, right: DataFrame, weights: DataFrame, *, id_l: str, id_r: str, words: str, blocks: str, least: float = 0.45, top: int = 6, unknown: float = 8.0) -> DataFrame:
    """(id_l, id_r, share, common): rows of ``right`` that hold at least ``least`` of a left row's word weight, best
    first, ``top`` at most. Only rows that share a block are compared; words without a weight weigh ``unknown``.

    Rows of equal words and blocks are one class: classes are compared, and each row gets the best rows of its class's matches, of
    which ``top`` a class are enough. Classes meet on a block and one of the heaviest words of the left one, as many as weigh more
    than 1 - least of it: a row that has none of these holds too little of the rest. So common words bring nothing together,
    crowds of copies do not grow with their square, and no pair is missed."""
    left, members_l = _classes(left, id_l, words, blocks)
    right, members_r = _classes(right, id_r, words, blocks)
    lw = left.select(id_l, blocks, F.explode(F.array_distinct(words)).alias("word")).join(weights.select("word", "idf"), "word", "left").select(id_l, blocks, "word", F.coalesce("idf", F.lit(unknown)).alias("w"))
    rows = lw.groupBy(id_l).agg(F.reverse(F.array_sort(F.collect_set(F.struct("w", "word")))).alias("__l"), F.array_distinct(F.flatten(F.collect_set(blocks))).alias("__b"))
    sum_of = lambda x: F.aggregate(x, F.lit(0.0), lambda a, e: a + e["w"])
    rows = rows.withColumn("mass", sum_of("__l"))
    before = lambda i: sum_of(F.slice("__l", 1, i))
    heavy = F.filter("__l", lambda _, i: before(i) <= (1 - least) * F.col("mass") + 1e-9)
    asked = rows.select(id_l, F.explode("__b").alias("block"), F.transform(heavy, lambda e: e["word"]).alias("h")).select(id_l, "block", F.explode("h").alias("word"))
    rw = right.select(id_r, F.explode(F.array_distinct(blocks)).alias("block"), words).select(id_r, "block", F.explode(F.array_distinct(words)).alias("word"))
    pairs = asked.join(rw, ["block", "word"]).select(id_l, id_r).distinct()
    said = right.groupBy(id_r).agg(F.array_distinct(F.flatten(F.collect_set(words))).alias("__r"))
    both = pairs.join(rows.select(id_l, "__l", "mass"), id_l).join(said, id_r)
    held = F.filter("__l", lambda e: F.array_contains(F.col("__r"), e["word"]))
    shares = both.select(id_l, id_r, "mass", held.alias("held")).select(id_l, id_r, (sum_of("held") / F.col("mass")).alias("share"), F.size("held").cast("long").alias("common")).filter(F.col("share") >= least)
    first = Window.partitionBy("__class").orderBy("__id")
    some = members_r.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= top)
    each = shares.join(some.select(F.col("__class").alias(id_r), "__id"), id_r).drop(id_r).withColumnRenamed("__id", id_r)
    order = Window.partitionBy(id_l).orderBy(F.desc("share"), id_r)
    best = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    return best.join(members_l.select(F.col("__class").alias(id_l), "__id"), id_l).select(F.col("__id").alias(id_l), id_r, "share", "common", "place")


def _classes(df: DataFrame, id_: str, words: str, blocks: str) -> tuple[DataFrame, DataFrame]:
    """The rows of one id of each class of equal words and blocks, and (__class, __id): which id each one's class is. An id
    with several rows has those of all."""
    flat = lambda c: F.array_sort(F.array_distinct(c))
    row = F.struct(flat(blocks).alias("b"), flat(words).alias("w"))
    by_id = df.filter(F.col(id_).isNotNull()).groupBy(id_).agg(F.array_sort(F.collect_set(row)).alias("__rows"))
    chosen = by_id.groupBy("__rows").agg(F.min(id_).alias("__class"))
    rows = chosen.select(F.col("__class").alias(id_), F.explode("__rows").alias("__row")).select(id_, F.col("__row.b").alias(blocks), F.col("__row.w").alias(words))
    return rows, by_id.join(chosen, "__rows").select("__class", F.col(id_).alias("__id"))

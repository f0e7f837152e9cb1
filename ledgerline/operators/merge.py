"""Records as facts (record, path, value): duplicates, merging without loss, differences."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls

# What stands for a fact that is not known, and a value with the narrower one that says the same and more.
BLANK = ("", "unknown", "not_announced")
NARROWER = (("pen_paper", "omr"),)


def blank(value: Column, words: tuple[str, ...] = BLANK) -> Column:
    return value.isNull() | value.isin(*words)


def name_words(title: Column) -> Column:
    """Lower-case words of a name without its years."""
    bare = F.regexp_replace(F.lower(title), r"(?<![0-9])(19|20)[0-9]{2}(-[0-9]{2,4})?(?![0-9])", " ")
    return F.filter(F.split(bare, "[^a-z0-9]+"), lambda w: w != "")


def duplicate_groups(df: DataFrame, key: list[str], id_: str, entity: str, unknown: tuple[str, ...] = ("unknown", "")) -> DataFrame:
    """(key, members): rows of one key that do not name two entities."""
    named = F.when(~F.col(entity).isin(*unknown), F.col(entity))
    g = df.groupBy(*key).agg(F.array_sort(F.collect_set(id_)).alias("members"), F.count_distinct(named).alias("entities"))
    return g.filter((F.size("members") > 1) & (F.col("entities") <= 1)).drop("entities")


def families(df: DataFrame, id_: str, words: str, same: list[str], variants: tuple[str, ...]) -> DataFrame:
    """(family, parts): rows named for a family (two words or more, none a variant) and two rows or more that are named
    for it plus variants only, no two alike.

    A part names its family: the words before its variants. So parts look their family up by equality; no prefix of
    anything is tried against everything."""
    is_variant = lambda w: w.isin(*variants)
    # the stem goes up to the last word that is no variant
    last = F.array_max(F.transform(words, lambda w, i: F.when(~is_variant(w), i + 1).otherwise(0)))
    x = df.select(id_, *same, words, F.slice(words, 1, F.coalesce(last, F.lit(0))).alias("__stem"))
    extra = F.slice(words, F.size("__stem") + 1, F.size(words))
    initials = lambda s: F.array_join(F.transform(s, lambda w: F.substring(w, 1, 1)), "")
    own = x.filter((F.size(words) >= 2) & ~F.exists(words, is_variant)).select(F.col(id_).alias("family"), *same, F.col(words).alias("__stem"))
    parts = x.filter((F.size("__stem") >= 2) & (F.size("__stem") < F.size(words))).select(F.col(id_).alias("part"), *same, "__stem", F.filter(extra, lambda w: w != initials(F.col("__stem"))).alias("extra"))
    # a name with two parts alike is no family, however many rows have it: only lists without such are put together
    counted = parts.filter(F.size("extra") > 0).groupBy(*same, "__stem", "extra").agg(F.count("*").alias("n"), F.min("part").alias("part"))
    of_name = counted.groupBy(*same, "__stem").agg((F.max("n") == 1).alias("apart"), F.collect_list(F.when(F.col("n") == 1, F.struct("part", "extra"))).alias("entries"))
    g = own.join(of_name, [*same, "__stem"]).groupBy("family").agg(F.bool_and("apart").alias("apart"), F.flatten(F.collect_list(F.when(F.col("apart"), F.col("entries")))).alias("entries"))
    kinds = F.size(F.array_distinct(F.transform("entries", lambda e: e["extra"])))
    g = g.filter(F.col("apart") & (F.size("entries") >= 2) & (kinds == F.size("entries")))
    return g.select("family", F.array_sort(F.transform("entries", lambda e: e["part"])).alias("parts"))


def papers(df: DataFrame, id_: str, words: str, same: list[str]) -> DataFrame:
    """(exam, papers): rows named for an exam and rows named for it, a subject and "paper". Each such row looks up all
    its beginnings of two words or more by equality."""
    own = df.filter((F.size(words) >= 2) & ~F.array_contains(words, "paper")).select(F.col(id_).alias("exam"), *same, F.col(words).alias("__stem"))
    last = df.filter((F.size(words) >= 4) & (F.element_at(words, -1) == "paper"))
    heads = F.explode(F.transform(F.sequence(F.lit(2), F.size(words) - 2), lambda n: F.slice(words, 1, n)))
    parts = last.select(F.col(id_).alias("paper"), *same, heads.alias("__stem"))
    return own.join(parts, [*same, "__stem"]).filter("exam <> paper").groupBy("exam").agg(F.array_sort(F.collect_set("paper")).alias("papers"))


def inside(outer: Column, inner: Column) -> Column:
    """Whether a link points into the folder that another link of the same site names: it says all that the other does."""
    folder = F.when(urls.path(outer) == "", "/").otherwise(urls.path(outer))
    return F.startswith(inner, F.lit("http")) & F.startswith(outer, F.lit("http")) & (urls.host(outer) == urls.host(inner)) & F.endswith(folder, F.lit("/")) & F.startswith(urls.path(inner), folder) & (urls.path(inner) != folder)


def says_less(a: Column, b: Column, narrower: tuple[tuple[str, str], ...] = NARROWER) -> Column:
    """Whether b says all that a says, and more."""
    pairs = [(a == wide) & (b == narrow) for wide, narrow in narrower]
    return reduce(or_, pairs, inside(a, b))


def most_telling(values: Column, narrower: tuple[tuple[str, str], ...] = NARROWER) -> Column:
    """The values of which no other says all, and more."""
    return F.filter(values, lambda a: ~F.exists(values, lambda b: says_less(a, b, narrower)))


def merge_facts(facts: DataFrame, group: str, path: str = "path", value: str = "value", *, additive: tuple[str, ...] = (), latest: tuple[str, ...] = (), narrower: tuple[tuple[str, str], ...] = NARROWER) -> DataFrame:
    """(group, path, value, conflict): the facts of the records of a group as one record. A blank yields to what is
    known, a wide value to a narrower one, a link to one inside its folder; of several known values the path is in conflict and has
    none, unless it is one of the ``additive`` paths, whose values are listed together, or one of the ``latest``, of which the largest
    value stays. Items of keyed lists are paths of their own, with the item's key in the path."""
    known = F.when(~blank(F.col(value)), F.col(value))
    newest = F.when(F.col(path).isin(*latest), F.slice(F.array_sort("known"), -1, 1)).otherwise(F.col("known")) if latest else F.col("known")
    g = facts.groupBy(group, path).agg(F.collect_set(known).alias("known"), F.min(value).alias("__blank"))
    g = g.withColumn("known", F.when(F.size("known") > 1, F.array_sort(most_telling(newest, narrower))).otherwise(F.col("known")))
    many = F.size("known") > 1
    listed = F.col(path).isin(*additive) if additive else F.lit(False)
    out = F.when(F.size("known") == 0, F.col("__blank")).when(~many, F.get("known", F.lit(0))).when(listed, F.array_join("known", "; "))
    return g.select(group, path, out.alias(value), (many & ~listed).alias("conflict"))


def lost(sources: DataFrame, merged: DataFrame, keys: list[str], narrower: tuple[tuple[str, str], ...] = NARROWER) -> DataFrame:
    """Known facts of the sources that the merged records state neither as they are nor by a value that says more."""
    gone = sources.select(*keys).filter(~blank(F.col(keys[-1]))).distinct().exceptAll(merged.select(*keys).distinct())
    at, value = keys[:-1], keys[-1]
    more = merged.select(*[F.col(c).alias(f"__{c}") for c in keys])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in at])
    return gone.join(more, same & says_less(F.col(value), F.col(f"__{value}"), narrower), "left_anti")


def diff(before: DataFrame, after: DataFrame, keys: list[str], value: str, status: str = r"^([a-z]+)(?::|$)", bookkeeping: tuple[str, ...] = ()) -> DataFrame:
    """(keys, before, after, kind): added, removed, changed, status-change (the same word with another state behind a
    colon) or unchanged; bookkeeping paths are marked."""
    b = before.select(*keys, F.col(value).alias("before"))
    a = after.select(*keys, F.col(value).alias("after"))
    x = b.join(a, keys, "full")
    word = lambda c: F.regexp_extract(c, status, 1)
    both_words = F.col("before").rlike(status) & F.col("after").rlike(status) & (word("before") == word("after"))
    kind = F.when(F.col("before").eqNullSafe(F.col("after")), "unchanged").when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(both_words, "status-change").otherwise("changed")
    marked = F.lit(False)
    for p in bookkeeping:
        marked = marked | F.startswith(F.col(keys[-1]), F.lit(p))
    return x.select(*keys, "before", "after", kind.alias("kind"), marked.alias("bookkeeping"))


def material(changes: DataFrame, record: str) -> DataFrame:
    """(record, changes): records with a change that is not bookkeeping."""
    return changes.filter((F.col("kind") != "unchanged") & ~F.col("bookkeeping")).groupBy(record).agg(F.count("*").alias("changes"))


def union_first(parts: list[DataFrame], by: list[str]) -> DataFrame:
    """All parts in order; of rows with one key the first, of equal rows one."""
    x = None
    for i, p in enumerate(parts):
        p = p.distinct().withColumn("__part", F.lit(i))
        x = p if x is None else x.unionByName(p, allowMissingColumns=True)
    rest = [F.col(c).asc_nulls_last() for c in x.columns if c not in (*by, "__part")]
    n = F.row_number().over(Window.partitionBy(*by).orderBy("__part", *rest))
    return x.withColumn("__n", n).filter("__n = 1").drop("__n", "__part")


def union_uncovered(first: DataFrame, second: DataFrame, by: str) -> DataFrame:
    """The first table, and of the second what the first does not cover."""
    return first.unionByName(second.join(first.select(by).distinct(), by, "left_anti"), allowMissingColumns=True)


def ordered_union(a: Column, b: Column) -> Column:
    return F.array_distinct(F.concat(a, b))

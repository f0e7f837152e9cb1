"""What is wrong with a set of tables: references, doubles, words outside a vocabulary, missing keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def references(child: DataFrame, id_: str, column: str, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """(rule, id, value) of values (or elements of a list) that the parent does not have."""
    many = child.schema[column].dataType.typeName() == "array"
    x = child.select(F.col(id_).cast("string").alias("id"), (F.explode(column) if many else F.col(column)).alias("v")).filter("v IS NOT NULL")
    return x.join(parent.select(F.col(key).alias("v")).distinct(), "v", "left_anti").select(F.lit(rule).alias("rule"), "id", F.col("v").cast("string").alias("value"))


def doubled(df: DataFrame, key: str, rule: str) -> DataFrame:
    return df.groupBy(F.col(key).cast("string").alias("id")).count().filter("count > 1").select(F.lit(rule).alias("rule"), "id", F.col("count").cast("string").alias("value"))


def outside(df: DataFrame, id_: str, column: str, words: list[str], rule: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*words)).select(F.lit(rule).alias("rule"), F.col(id_).cast("string").alias("id"), F.col(column).cast("string").alias("value"))


def required(df: DataFrame, id_: str, columns: list[str], rule: str) -> DataFrame:
    missing = F.explode(F.filter(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in columns]), lambda c: c.isNotNull()))
    return df.select(F.lit(rule).alias("rule"), F.col(id_).cast("string").alias("id"), missing.alias("value"))


def like(df: DataFrame, id_: str, column: str, pattern: str, rule: str, wanted: bool = True) -> DataFrame:
    """Values that do not match (or, with ``wanted`` false, that do)."""
    bad = ~F.col(column).rlike(pattern) if wanted else F.col(column).rlike(pattern)
    return df.filter(bad).select(F.lit(rule).alias("rule"), F.col(id_).cast("string").alias("id"), F.col(column).cast("string").alias("value"))


def together(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def shape(example: DataFrame, path: str = "path", kind: str = "kind", required_: str = "required") -> DataFrame:
    """The shape that an annotated example shows: (path, kind, required)."""
    return example.groupBy(path).agg(F.first(kind).alias(kind), F.max(required_).alias(required_))


def check_shape(facts: DataFrame, shape_: DataFrame, record: str = "record", path: str = "path", kind: str = "kind") -> DataFrame:
    """(record, path, problem): unknown path, wrong kind, missing required path. The shape is a schema: it is read to
    the driver, and what a record lacks is a difference of arrays."""
    rows = shape_.select(path, kind, "required").collect()
    if not rows:
        return facts.select(record, path, F.lit("unknown key").alias("problem"))
    kinds = F.create_map(*[F.lit(x) for r in rows for x in (r[path], r[kind])])
    want = F.try_element_at(kinds, F.col(path))
    wrong = facts.select(record, path, F.when(want.isNull(), "unknown key").when(want != F.col(kind), "wrong kind").alias("problem")).filter("problem IS NOT NULL")
    needed = [r[path] for r in rows if r.required]
    have = facts.groupBy(record).agg(F.collect_set(F.when(F.col(path).isin(*needed), F.col(path))).alias("have"))
    lacking = F.explode(F.array_except(F.array(*[F.lit(p) for p in needed]).cast("array<string>"), "have"))
    return wrong.unionByName(have.select(record, lacking.alias(path), F.lit("missing").alias("problem")))


def coverage(parent: DataFrame, key: str, child: DataFrame, foreign: str) -> DataFrame:
    """(key, total, seen): per parent, how many children there are and how many are marked as seen."""
    c = child.groupBy(F.col(foreign).alias(key)).agg(F.count("*").alias("total"), F.count_if("seen").alias("seen"))
    return parent.select(key).join(c, key, "left").select(key, F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("seen", F.lit(0)).alias("seen"))


def counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), the missing as "-", most first."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("-")).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")

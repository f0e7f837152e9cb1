"""Proposals from what nothing has matched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def examples(df: DataFrame, by: list[str], example: Column, order: list[Column], k: int = 3) -> DataFrame:
    """(by, n, examples): each group's size and its first k examples."""
    first = df.withColumn("__e", example).withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= k)
    shown = first.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__e"))), lambda s: s["__e"]).alias("examples"))
    return df.groupBy(*by).agg(F.count("*").alias("n")).join(shown, by)


def mode(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value): the most frequent value of each group, the greatest of equally frequent ones."""
    n = df.groupBy(*by, value).agg(F.count("*").alias("__n"))
    return n.groupBy(*by).agg(F.max(F.struct("__n", value)).alias("__m")).select(*by, F.col("__m")[value].alias(value))


def proposals(df: DataFrame, by: list[str], name: str, strong: Column, year: Column, least: int = 2) -> DataFrame:
    """(by, name, score, rows, strong, years) of the series worth proposing: score is rows + 2 strong rows + distinct
    years; those with a single row that is not strong are left out."""
    x = df.withColumns({"__strong": strong, "__year": year})
    g = x.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if("__strong").alias("strong"), F.count_distinct("__year").alias("years"))
    g = g.filter((F.col("rows") >= least) | (F.col("strong") > 0)).withColumn("score", F.col("rows") + 2 * F.col("strong") + F.col("years"))
    return g.join(mode(df, by, name), by)


def initials(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def acronyms(df: DataFrame, id_: str, words: str, same: list[str]) -> DataFrame:
    """(acronym, full): one-word names that are the initials of a longer name of the same group."""
    short = df.filter(F.size(words) == 1).select(*same, F.col(id_).alias("acronym"), F.get(words, F.lit(0)).alias("__i"))
    full = df.filter(F.size(words) >= 2).select(*same, F.col(id_).alias("full"), initials(F.col(words)).alias("__i"))
    return short.join(full, [*same, "__i"]).select("acronym", "full")


def unknown_only(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return found.join(known.select(key).distinct(), key, "left_anti")

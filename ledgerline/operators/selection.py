"""Choosing under budgets: caps for each group, turns among groups, best of each group."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def capped(df: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """At most so many rows of each group."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def keep_first(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; rows with a null in the key are no repeats of each other. The limit on row_number
    alone is what lets Spark drop repeats before the shuffle, so the null keys go another way."""
    null = reduce(or_, [F.col(c).isNull() for c in by])
    first = df.filter(~null).withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__n = 1").drop("__n")
    return first.unionByName(df.filter(null))


def turns(df: DataFrame, by: str, order: list[Column], priority: list[Column]) -> DataFrame:
    """Rows in turns: the first of every group in order of priority, then the second of every group, and so on, as
    ``round`` and ``turn``."""
    x = df.withColumn("round", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return x.withColumn("turn", F.row_number().over(Window.partitionBy("round").orderBy(*priority, by)))


def budget(df: DataFrame, *, group: str, host: str, order: list[Column], priority: list[Column], fresh: Column, per_group: int = 2, per_host: int = 3, limit: int = 50) -> DataFrame:
    """The work of a run, with its place.

    The newest ``per_group`` fresh rows of each group come first, in ``order``; then the rest in turns, groups in order
    of ``priority``. Of that queue each host gets ``per_host`` rows, and the run ``limit``. The last cut is a top-k, so
    the queue is never sorted as a whole by one task: its key is (stage, round, order)."""
    x = df.withColumn("__fresh", fresh)
    n = F.row_number().over(Window.partitionBy(group, "__fresh").orderBy(*order))
    x = x.withColumn("__kept", F.col("__fresh") & (n <= per_group))
    x = x.withColumn("__round", F.when(F.col("__kept"), 0).otherwise(F.row_number().over(Window.partitionBy(group, "__kept").orderBy(*order))))
    queue = [F.col("__kept").desc(), F.col("__round"), *[F.when(~F.col("__kept"), p).asc_nulls_first() for p in priority], *order]
    x = x.withColumn("__h", F.row_number().over(Window.partitionBy(host).orderBy(*queue))).filter(F.col("__h") <= per_host)
    top = x.orderBy(*queue).limit(limit)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*queue))).drop("__fresh", "__kept", "__round", "__h")


def buckets(df: DataFrame, by: str, order: list[Column], size: int) -> DataFrame:
    """Rows dealt into buckets of at most ``size``, named by the group, with a number only where it has several."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    all_ = F.count("*").over(Window.partitionBy(by))
    part = F.floor(n / size) + 1
    return df.withColumn("bucket", F.when(all_ > size, F.concat(F.col(by).cast("string"), F.lit("-"), part.cast("string"))).otherwise(F.col(by).cast("string")))


def rotation(df: DataFrame, day: Column, n: int, key: str) -> DataFrame:
    """The rows whose turn it is on a day: one of n shares of the keys, by a hash that every engine has."""
    share = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % n
    return df.filter(share == F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(n)))


def filled_down(df: DataFrame, key: str, order: list[Column | str], label: Column, name: str) -> DataFrame:
    """Rows with ``name``: the last label that was stated at or above them. A key's rows are sorted in one task; a key that holds a
    large share of all rows should be cut into pages first, whose first rows take over the label of the page before."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(label, ignorenulls=True).over(w))


def with_neighbour(df: DataFrame, key: str, order: list[Column | str], columns: dict[str, Column], step: int = 1) -> DataFrame:
    """Rows with columns of the row ``step`` places above them (below, if negative), by new name. Sorted as in ``filled_down``."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({name: F.lag(c, step).over(w) for name, c in columns.items()})


def soonest(df: DataFrame, by: str, day: str, today: Column, ties: list[Column]) -> DataFrame:
    """The nearest day to come of each group; of equal ones the first of ``ties``."""
    ahead = df.filter(F.col(day) >= today)
    return ahead.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(day, *ties))).filter("__n = 1").drop("__n")


def stalest(df: DataFrame, by: str, checked: str) -> DataFrame:
    """(group, checked): when a group's least lately checked row was checked, never before all."""
    return df.groupBy(by).agg(F.when(F.count_if(F.col(checked).isNull()) > 0, F.lit(None)).otherwise(F.min(checked)).alias(checked))


def top_live(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)

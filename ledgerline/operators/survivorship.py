"""One value for each entity and field out of many documents."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick(df: DataFrame, by: list[str], rank: list[Column]) -> DataFrame:
    """The best row of each group by rank, with ``alternatives``, the number of others. The row is found by a limit on
    row_number, which Spark applies before the shuffle too, and the number by a count: no group is gathered whole."""
    best = df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*rank))).filter("__n = 1").drop("__n")
    return _with_count(best, df, by)


def _with_count(best: DataFrame, df: DataFrame, by: list[str]) -> DataFrame:
    n = df.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg((F.count("*") - 1).alias("alternatives"))
    same = [best[c].eqNullSafe(n[f"__{c}"]) for c in by]
    return best.join(n, reduce(and_, same)).drop(*[f"__{c}" for c in by])


def current_cycle(df: DataFrame, entity: str, cycle: str) -> DataFrame:
    """Rows with ``current``, the latest cycle of their entity."""
    latest = df.groupBy(F.col(entity).alias("__entity")).agg(F.max(cycle).alias("current"))
    return df.join(latest, df[entity].eqNullSafe(latest["__entity"])).drop("__entity")


def carried(df: DataFrame, entity: str, field: str, cycle: str, value: str, rank: list[Column], per_cycle: tuple[str, ...]) -> DataFrame:
    """The value of each field: of the current cycle, else of the newest earlier cycle that has one, with
    ``carried_from``. The fields ``per_cycle`` are never carried over."""
    x = current_cycle(df, entity, cycle).filter(F.col(value).isNotNull())
    x = x.filter((F.col(cycle) == F.col("current")) | ~F.col(field).isin(*per_cycle))
    best = x.withColumn("__n", F.row_number().over(Window.partitionBy(entity, field).orderBy(F.desc(cycle), *rank))).filter("__n = 1").drop("__n")
    return _with_count(best, x, [entity, field, cycle]).withColumn("carried_from", F.when(F.col(cycle) < F.col("current"), F.col(cycle))).drop("current")


def gaps(profile: DataFrame, entities: DataFrame, entity: str, field: str, expected: list[str]) -> DataFrame:
    """(entity, gaps): expected fields that an entity's profile lacks, in their order; entities without any have all."""
    have = profile.groupBy(entity).agg(F.collect_set(field).alias("have"))
    want = F.array(*[F.lit(f) for f in expected])
    return entities.select(entity).join(have, entity, "left").select(entity, F.array_except(want, F.coalesce("have", F.array().cast("array<string>"))).alias("gaps"))


def adjudicate(df: DataFrame, by: list[str], *, granularity: str, hint: str, page: str, value: str, tie: list[Column], dates: tuple[str, ...] = (), field: str = "field") -> DataFrame:
    """One candidate for each group: month-level ones are notes, never values; then the higher hint (a date that is
    not a day last), the earlier page. With the numbers of the others and notes, and whether the values differ."""
    w = Window.partitionBy(*by, "__month")
    x = df.withColumn("__month", F.col(granularity) == "month")
    weight = F.when((F.col(granularity) != "day") & F.col(field).isin(*dates), -1.0).otherwise(F.col(hint)) if dates else F.col(hint)
    x = x.withColumns({
        "__n": F.row_number().over(w.orderBy(weight.desc(), F.coalesce(F.col(page), F.lit(0)), *tie)),
        "__lo": F.min(value).over(w), "__hi": F.max(value).over(w),
        "rejected": F.count("*").over(w) - 1,
        "notes": F.count_if(F.col("__month")).over(Window.partitionBy(*by)),
    })
    x = x.filter("__n = 1").withColumn("__one", F.row_number().over(Window.partitionBy(*by).orderBy("__month"))).filter("__one = 1")
    coarse = F.col("__month")
    return x.select(*by, F.when(~coarse, F.col(value)).alias(value), F.when(coarse, 0).otherwise(F.col("rejected")).alias("rejected"), F.when(coarse, False).otherwise(F.col("__lo") != F.col("__hi")).alias("conflict"), "notes")


def first_known(df: DataFrame, by: list[str], values: list[str], rank: list[Column]) -> DataFrame:
    """For each column the first value that is not null, in ascending rank order: one partial aggregation."""
    keys = [r.alias(f"k{i}") for i, r in enumerate(rank)]
    return df.groupBy(*by).agg(*[F.min(F.when(F.col(v).isNotNull(), F.struct(*keys, F.col(v).alias("v")))).getField("v").alias(v) for v in values])


def agreement(left: DataFrame, right: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """(field, both, agree): where both tables state a value, how often it is the same."""
    x = left.join(right.select(*key, *[F.col(v).alias(f"r_{v}") for v in values]), key)
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("field"), F.col(v).cast("string").alias("a"), F.col(f"r_{v}").cast("string").alias("b")) for v in values]))
    return x.select(pairs.alias("p")).select("p.*").filter("a IS NOT NULL AND b IS NOT NULL").groupBy("field").agg(F.count("*").alias("both"), F.count_if(F.col("a") == F.col("b")).alias("agree"))


def total_by_key(df: DataFrame, by: list[str], maps: str) -> DataFrame:
    """Maps of counts, summed by key over the rows of a group: (by, key, total)."""
    return df.select(*by, F.explode(maps).alias("key", "n")).groupBy(*by, "key").agg(F.sum("n").alias("total"))

"""Ranked search with facets over cards, and a calendar over dated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import query_score


def cards(df: DataFrame, hay: Column, query: str, *, where: list[Column] | None = None, order: list[Column] | None = None) -> DataFrame:
    """Cards that match a query and all filters, with their score, best first."""
    x = df
    for w in where or []:
        x = x.filter(w)
    x = x.withColumn("score", query_score(F.lower(hay), query)).filter("score >= 0")
    return x.orderBy("score", *(order or []))


def facets(df: DataFrame, id_: str, values: str) -> DataFrame:
    """(value, n) over the lists of values, each counted once a card."""
    return df.select(id_, F.explode(F.array_distinct(values)).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def months(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def calendar(df: DataFrame, day: str, today: Column, *, month: str | None = None, where: list[Column] | None = None) -> DataFrame:
    """Events that pass the filters, with the part of the page they go to: today, ahead, earlier."""
    x = df if month is None else df.filter(F.date_format(day, "yyyy-MM") == month)
    for w in where or []:
        x = x.filter(w)
    return x.withColumn("part", F.when(F.to_date(day) == today, "today").when(F.to_date(day) > today, "ahead").otherwise("earlier"))

"""Ranked search, facets, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search
from ..registry import register, table


def _score_sql(hay: str, term: str, allow: int) -> str:
    parts = f"string_split_regex({hay}, '[^a-z0-9]+')"
    near = f"(len(list_filter({parts}, lambda w: w <> '' AND abs(length(w) - {len(term)}) <= {allow} AND levenshtein(w, '{term}') <= {allow})) > 0 OR (abs(length({hay}) - {len(term)}) <= {allow} AND levenshtein({hay}, '{term}') <= {allow}))" if allow else "false"
    return f"""CASE WHEN list_contains({parts}, '{term}') THEN 1 WHEN contains({hay}, '{term}') THEN 2 WHEN len(list_filter({parts}, lambda w: starts_with(w, '{term}'))) > 0 THEN 3 WHEN {near} THEN 4 ELSE -1 END"""


@register(f"""WITH x AS (SELECT p_partkey, p_name, {_score_sql("lower(p_name)", "gren", 1)} AS a, {_score_sql("lower(p_name)", "widgit", 2)} AS b FROM part WHERE p_size <= 40),
s AS (SELECT p_partkey, p_name, CASE WHEN a < 0 THEN b WHEN b < 0 THEN a ELSE least(a, b) END AS score FROM x) SELECT p_partkey, p_name, score FROM s WHERE score >= 0""")
def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards that about match a query, best first."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return search.cards(part, F.col("p_name"), "gren, widgit", where=[F.col("p_size") <= 40], order=[F.col("p_partkey")]).select("p_partkey", "p_name", "score")


@register("SELECT b AS value, count(*) AS n FROM (SELECT DISTINCT o_custkey, unnest([o_orderstatus, o_orderpriority, 'all']) AS b, o_orderkey FROM orders) GROUP BY 1")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cards each value of a list has."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority", F.lit("all")).alias("values"))
    return search.facets(o, "o_orderkey", "values")


@register("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def month_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.months(table(spark, sf_dir, "orders"), "o_orderdate")


@register("""SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN 'today' WHEN CAST(ts AS DATE) > DATE '2024-01-15' THEN 'ahead' ELSE 'earlier' END AS part
FROM events WHERE strftime(ts, '%Y-%m') = '2024-01' AND event_type IN ('signup', 'purchase') AND value > 20""")
def calendar_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month's events that pass the filters, by part of the page."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    found = search.calendar(e, "ts", F.lit("2024-01-15").cast("date"), month="2024-01", where=[F.col("event_type").isin("signup", "purchase"), F.col("value") > 20])
    return found.select("event_id", "part")

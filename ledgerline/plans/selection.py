"""Budgets, turns, caps, buckets, newest rows, waits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import selection
from ..registry import register, table


@register("""WITH x AS (SELECT o_orderkey, o_custkey AS g, o_custkey % 97 AS host, o_totalprice, o_orderdate >= DATE '2001-01-01' AS fresh FROM orders),
k AS (SELECT *, fresh AND row_number() OVER (PARTITION BY g, fresh ORDER BY o_totalprice DESC, o_orderkey) <= 2 AS kept FROM x),
r AS (SELECT *, CASE WHEN kept THEN 0 ELSE row_number() OVER (PARTITION BY g, kept ORDER BY o_totalprice DESC, o_orderkey) END AS round FROM k),
h AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY kept DESC, round, CASE WHEN NOT kept THEN g END NULLS FIRST, o_totalprice DESC, o_orderkey) AS n FROM r),
t AS (SELECT *, row_number() OVER (ORDER BY kept DESC, round, CASE WHEN NOT kept THEN g END NULLS FIRST, o_totalprice DESC, o_orderkey) AS place FROM h WHERE n <= 3)
SELECT o_orderkey, place FROM t WHERE place <= 200""")
def select_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The work of one run: two fresh rows a group, gaps in turns, three a host, so many in all (W1-W3). The limit is
    the feature: a run's budget."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("g"), (F.col("o_custkey") % 97).alias("host"), "o_totalprice", "o_orderdate")
    found = selection.budget(o, group="g", host="host", order=[F.desc("o_totalprice"), F.asc("o_orderkey")], priority=[F.col("g")], fresh=F.col("o_orderdate") >= F.lit("2001-01-01").cast("date"), limit=200)
    return found.select("o_orderkey", "place")


@register("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS round FROM lineitem)
SELECT *, row_number() OVER (PARTITION BY round ORDER BY l_suppkey) AS turn FROM r""")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of groups in turns."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return selection.turns(x, "l_suppkey", [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")], []).drop("l_extendedprice")


@register("""WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey) AS a FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS b FROM f WHERE a = 1)
SELECT l_orderkey, l_linenumber, l_returnflag FROM k WHERE b <= 2""")
def cap_per_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most two of a kind, repeats not counted."""
    x = selection.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag", "l_quantity"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")])
    return selection.capped(x, ["l_orderkey", "l_returnflag"], [F.desc("l_shipdate"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")], 2).select("l_orderkey", "l_linenumber", "l_returnflag")


@register("""WITH n AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS n, count(*) OVER (PARTITION BY c_nationkey) AS a FROM customer)
SELECT CASE WHEN a > 20 THEN c_nationkey || '-' || (n // 20 + 1) ELSE CAST(c_nationkey AS VARCHAR) END AS bucket, count(*) AS n, min(c_custkey) AS first_key FROM n GROUP BY 1""")
def bucket_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work dealt into buckets of twenty."""
    x = selection.buckets(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", [F.col("c_custkey")], 20)
    return x.groupBy("bucket").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"))


@register("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 300")
def topk_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest live rows (T2, K3); a top-k by nature."""
    live = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return selection.top_live(live, [F.desc("o_orderdate"), F.desc("o_orderkey")], 300).select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))


@register("SELECT c_custkey, CAST(least(7 * power(2, greatest(c_custkey % 9, 1) - 1), 90) AS INTEGER) AS days FROM customer")
def retry_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to wait after failures."""
    return table(spark, sf_dir, "customer").select("c_custkey", dates.wait_days(F.col("c_custkey") % 9).alias("days"))


@register("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey DESC) AS n FROM orders WHERE o_orderdate >= DATE '2001-01-01')
SELECT o_custkey, o_orderkey, date_diff('day', DATE '2001-01-01', CAST(o_orderdate AS DATE)) AS days FROM a WHERE n = 1""")
def days_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The soonest day of each body, the newest of equal ones."""
    today = F.lit("2001-01-01").cast("date")
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return selection.soonest(o, "o_custkey", "day", today, [F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", F.datediff("day", today).cast("long").alias("days"))


@register("""SELECT o_custkey, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN NULL ELSE CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) END AS checked FROM orders GROUP BY 1""")
def stalest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the least lately checked row of each body was checked, never first."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("checked"))
    return selection.stalest(o, "o_custkey", "checked").withColumn("checked", F.col("checked").cast("string"))


@register("""SELECT o_orderkey, CASE WHEN d < 0 THEN 'past' WHEN d = 0 THEN 'today' WHEN d = 1 THEN 'tomorrow' WHEN d <= 7 THEN 'this week' WHEN d <= 30 THEN 'this month' ELSE 'later' END AS bucket, d BETWEEN 0 AND 7 AS urgent
FROM (SELECT o_orderkey, date_diff('day', DATE '2001-07-01', CAST(o_orderdate AS DATE)) AS d FROM orders)""")
def countdown_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far off a day is, for readers."""
    day, today = F.to_date("o_orderdate"), F.lit("2001-07-01").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.countdown(day, today).alias("bucket"), dates.urgent(day, today).alias("urgent"))


@register("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority NOT IN ('5-LOW') AND CAST(o_orderdate AS DATE) >= greatest(DATE '2001-08-01' - 730, DATE '2001-08-01' - 3650) AND o_totalprice > 1000")
def wanted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows worth the work: live, of a wanted kind, not stale."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    latest = F.lit("2001-08-01").cast("date")
    fresh = F.col("day") >= F.date_sub(latest, 730)
    return o.filter((F.col("o_orderstatus") == "O") & ~F.col("o_orderpriority").isin("5-LOW") & fresh & (F.col("o_totalprice") > 1000)).select("o_orderkey")

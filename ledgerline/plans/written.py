"""Documents, index lines, reviews and totals as they are written. Documents are orders, feeds customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..registry import register, table
from ..sources import records


@register("""WITH x AS (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS id, 'Order | ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS b FROM orders)
SELECT id, substr(id, 1, 2) AS shard, '{"id":"' || id || '","title":"' || title || '","facts":{' || concat_ws(',', '"priority":"' || a || '"', '"status":"' || b || '"') || '}}' AS json,
'# ' || replace(title, '|', '\\|') || chr(10) || CASE WHEN a IS NULL AND b IS NULL THEN '' ELSE chr(10) || '| | |' || chr(10) || '|---|---|' || chr(10) || concat_ws(chr(10), '| priority | ' || a || ' |', '| status | ' || b || ' |') || chr(10) END AS markdown FROM x""")
def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON and Markdown, by shard (K5)."""
    k = F.col("o_orderkey")
    fact = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    facts = F.array(fact("priority", F.when(k % 3 != 0, F.col("o_orderpriority"))), fact("status", F.when(k % 5 != 0, F.col("o_orderstatus"))))
    x = table(spark, sf_dir, "orders").select(F.md5(k.cast("string")).alias("id"), F.concat(F.lit("Order | "), k.cast("string")).alias("title"), facts.alias("facts"))
    return records.documents(x, "id", "title", "facts")


@register("""SELECT o_orderkey AS id, '{' || concat_ws(',', '"id":' || o_orderkey, '"status":"' || CASE o_orderstatus WHEN 'F' THEN 'ok' ELSE 'failed' END || '"', CASE WHEN o_orderstatus = 'F' THEN '"pages":' || o_orderkey % 40 END, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 > 0 THEN '"tables":' || o_orderkey % 3 END) || '}' AS line FROM orders""")
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an index says of documents (K6)."""
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), (F.col("o_orderkey") % 40).alias("pages"), (F.col("o_orderkey") % 3).alias("tables"))
    return records.index_line(x, "o_orderkey", "status", "pages", "tables")


@register("""WITH b AS (SELECT o_custkey AS record, 'p' || o_orderkey % 4 AS path, min(o_orderpriority) AS v FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY ALL), a AS (SELECT o_custkey AS record, 'p' || o_orderkey % 4 AS path, max(o_orderpriority) AS v FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY ALL),
c AS (SELECT record, path, concat_ws(chr(10), '- ' || path || ': ' || b.v, '+ ' || path || ': ' || a.v) AS lines FROM b FULL JOIN a USING (record, path) WHERE b.v IS DISTINCT FROM a.v AND NOT starts_with(path, 'p3'))
SELECT record, count(*) AS changes, string_agg(lines, chr(10) ORDER BY path) AS patch FROM c GROUP BY record""")
def review_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of records as patches for a reader."""
    o = table(spark, sf_dir, "orders").withColumn("path", F.concat(F.lit("p"), (F.col("o_orderkey") % 4).cast("string")))
    side = lambda keep, best: o.filter(keep).groupBy(F.col("o_custkey").alias("record"), "path").agg(best("o_orderpriority").alias("value"))
    changes = merge.diff(side(F.col("o_orderkey") % 5 != 0, F.min), side(F.col("o_orderkey") % 7 != 0, F.max), ["record", "path"], "value", bookkeeping=("p3",))
    return records.review(changes, "record")


@register("SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def document_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents there are of each state and kind."""
    return records.totals(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("""WITH b AS (SELECT c_name FROM customer WHERE c_custkey % 9 = 4) SELECT (SELECT count(*) FROM b) AS broken, (SELECT string_agg(c_name, ', ' ORDER BY c_name) FROM (SELECT c_name FROM b ORDER BY c_name LIMIT 10)) AS first""")
def standing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds that are broken now, however long."""
    health = table(spark, sf_dir, "customer").select("c_name", F.when(F.col("c_custkey") % 9 == 4, "failing for a day").alias("alert"))
    return records.standing(health, "c_name", "alert")


@register("""WITH n AS (SELECT o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_orderpriority AS kind, 2 * count(*) AS n FROM orders WHERE o_orderpriority < '3' GROUP BY 1)
SELECT kind, greatest(CASE WHEN n.n >= 1000 THEN n.n - n.n % 1000 ELSE n.n END, coalesce(b.n, 0)) AS n FROM n LEFT JOIN b USING (kind)""")
def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts as they are published: rounded down, never less than before."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "kind")
    before = o.filter("kind < '3'").groupBy("kind").agg((2 * F.count("*")).alias("n"))
    return records.grown(o.groupBy("kind").agg(F.count("*").alias("n")), before, "kind", "n")

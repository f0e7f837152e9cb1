"""Scores against labels: here the length of a document against its quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation
from ..registry import register, table


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", ((F.col("n_chars") % 1000) / 1000).alias("p"))
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").select("p", (F.col("quality") == 1).alias("present"), (F.col("toxic") == 1).alias("toxic"))


_X = "x AS (SELECT (n_chars % 1000) / 1000 AS p, quality = 1 AS present, toxic = 1 AS toxic FROM documents JOIN labels USING (doc_id))"


@register(f"WITH {_X} SELECT (SELECT count(*) FROM x WHERE present) AS n_pos, (SELECT count(*) FROM x WHERE NOT present) AS n_neg, round(avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END), 9) AS auc FROM x a, x b WHERE a.present AND NOT b.present")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area under the curve, from counts by score."""
    return evaluation.auc(_scored(spark, sf_dir), "p", "present").withColumn("auc", F.round("auc", 9))


@register(f"""WITH {_X}, c AS (SELECT unnest(generate_series(1, 19)) AS step)
SELECT step / 20 AS cut, count(*) FILTER (WHERE present AND floor(p * 20) >= step) AS tp, count(*) FILTER (WHERE NOT present AND floor(p * 20) >= step) AS fp, count(*) FILTER (WHERE present AND floor(p * 20) < step) AS fn, count(*) FILTER (WHERE NOT present AND floor(p * 20) < step) AS tn,
 count(*) FILTER (WHERE (floor(p * 20) >= step) = present) / count(*) AS accuracy FROM x, c GROUP BY step""")
def auc_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion and accuracy at nineteen cuts."""
    return evaluation.sweep(_scored(spark, sf_dir), "p", "present")


@register(f"WITH {_X} SELECT CAST(least(floor(p * 5), 4) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 9) AS mean_score, round(avg(CAST(present AS INTEGER)), 9) AS share, round(abs(avg(p) - avg(CAST(present AS INTEGER))), 9) AS gap FROM x GROUP BY 1")
def calibration_ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability by bin."""
    c = evaluation.calibration(_scored(spark, sf_dir), "p", "present")
    return c.withColumns({k: F.round(k, 9) for k in ("mean_score", "share", "gap")})


@register('SELECT event_type, count(value) AS n, median(value) AS median, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean FROM events GROUP BY 1')
def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, median, extremes and mean."""
    return evaluation.latency(table(spark, sf_dir, "events"), ["event_type"], "value").withColumn("mean", F.round("mean", 6))


@register("""WITH x AS (SELECT c_mktsegment AS truth, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS found FROM customer),
g AS (SELECT count(*) FILTER (WHERE found = truth) AS "right", count(*) FILTER (WHERE found IS NOT NULL AND found IS DISTINCT FROM truth) AS wrong, count(*) FILTER (WHERE truth IS NOT NULL AND found IS DISTINCT FROM truth) AS missed FROM x)
SELECT "right", wrong, missed, "right" / ("right" + wrong) AS precision, "right" / ("right" + missed) AS recall FROM g""")
def pick_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of values found."""
    x = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("truth"), F.when(F.col("c_custkey") % 5 == 0, None).when(F.col("c_custkey") % 3 == 0, "BUILDING").otherwise(F.col("c_mktsegment")).alias("found"))
    return evaluation.picks(x, "truth", "found")


@register("""WITH x AS (SELECT l_orderkey, l_linenumber, l_linenumber % 4 > 0 AS has, l_returnflag = 'N' AND l_linenumber = 5 AS portal, l_linestatus = 'O' AS available, l_quantity > 5 AS asked, l_tax * 10 AS publish, l_discount < 0.08 AS confident,
 CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 7 = 1 THEN 'none_of_these' ELSE 'a' END AS choice, l_suppkey % 2 = 0 AS same, l_discount * 5 AS confidence FROM lineitem)
SELECT v AS verdict, count(*) AS n FROM (SELECT CASE WHEN NOT has THEN 'absent' WHEN portal THEN 'heuristic' WHEN NOT available THEN 'not_validated' WHEN NOT asked OR choice IS NULL THEN 'not_validated' WHEN publish <= 0.30 AND confident THEN 'undecided'
 WHEN choice = 'none_of_these' THEN 'disputed' WHEN confidence < 0.25 THEN 'undecided' WHEN same THEN 'verified' ELSE 'disputed' END AS v FROM x) GROUP BY 1""")
def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is made of values after verification."""
    c = F.col
    v = evaluation.verdict(
        has_candidate=c("l_linenumber") % 4 > 0, portal=(c("l_returnflag") == "N") & (c("l_linenumber") == 5), available=c("l_linestatus") == "O", asked=c("l_quantity") > 5,
        publish=c("l_tax") * 10, confident=c("l_discount") < 0.08, choice=F.when(c("l_partkey") % 7 == 0, None).when(c("l_partkey") % 7 == 1, "none_of_these").otherwise("a"), same=c("l_suppkey") % 2 == 0, confidence=c("l_discount") * 5,
    )
    return table(spark, sf_dir, "lineitem").groupBy(v.alias("verdict")).agg(F.count("*").alias("n"))

"""Streaming twins of the state queries, run over what is available."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import register
from ..session import shared_dir
from ..streaming.snapshots import StateTable, health_stream, merge_stream

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("""SELECT DISTINCT event_type || '/' || user_id AS id, event_type AS feed, CAST((SELECT CAST(max(ts) AS DATE) FROM events) AS VARCHAR) AS first_seen, CAST(NULL AS VARCHAR) AS gone_since FROM events""")
def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state table after a stream of observations (ST1)."""
    folder = _folder(spark, "stream-snapshot")
    rows = _events(spark, sf_dir).select(F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("id"), F.col("event_type").alias("feed"), F.to_date("ts").alias("day"), F.lit(True).alias("ok"))
    state = StateTable(spark, f"{folder}/state", "id string, feed string, day date, first_seen date, gone_since date")
    merge_stream(rows, state, f"{folder}/checkpoint", now=lambda b: F.lit(b.agg(F.max("day")).first()[0])).awaitTermination()
    return state.latest().select("id", "feed", F.col("first_seen").cast("string").alias("first_seen"), F.col("gone_since").cast("string").alias("gone_since"))


@register("""WITH e AS (SELECT user_id AS id, event_type <> 'error' AS ok, CASE WHEN event_type <> 'error' THEN 200 ELSE 500 END AS status, CAST(trunc(value / 50) AS BIGINT) AS n, epoch_us(ts) AS checked FROM events),
o AS (SELECT *, row_number() OVER w AS i, lag(ok) OVER w AS p_ok, lag(n) OVER w AS p_n FROM e WINDOW w AS (PARTITION BY id ORDER BY checked, status, n)),
r AS (SELECT *, sum(CASE WHEN p_ok IS NULL OR p_ok <> ok OR (p_n > 0) <> (n > 0) THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS run FROM o),
s AS (SELECT *, min(checked) OVER (PARTITION BY id, run) AS since, min(i) OVER (PARTITION BY id, run) = i AS starts, first_value(p_n) OVER (PARTITION BY id, run ORDER BY i) AS n_before FROM r),
a AS (SELECT *, CASE WHEN ok AND NOT n > 0 AND n_before > 0 THEN 'yield dropped to zero' WHEN NOT ok AND checked - since >= 86400000000 THEN 'failing for a day' END AS alert FROM s)
SELECT id, checked, since, alert, CASE WHEN ok THEN alert IS NOT NULL AND starts ELSE alert IS NOT NULL AND coalesce(lag(alert) OVER (PARTITION BY id ORDER BY i), '') <> 'failing for a day' END AS raised FROM a""")
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health lines and alerts from a stream of results, with Spark keeping each feed's last line (ST3)."""
    folder = _folder(spark, "stream-health")
    good = F.col("event_type") != "error"
    results = _events(spark, sf_dir).select(F.col("user_id").alias("id"), good.alias("ok"), F.when(good, 200).otherwise(500).cast("long").alias("status"), (F.col("value") / 50).cast("long").alias("count"), F.unix_micros(F.col("ts").cast("timestamp")).alias("checked"))
    health_stream(results).writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema("id long, checked long, since long, alert string, raised boolean").parquet(f"{folder}/out")

from pyspark.sql import functions as F

from ledgerline.operators import state
from ledgerline.streaming.snapshots import StateTable, health_stream, merge_stream

SCHEMA = "id string, feed string, day date, first_seen date, gone_since date"


def write(spark, rows, path):
    spark.createDataFrame(rows, "id string, feed string, day string, ok boolean").withColumn("day", F.to_date("day")).coalesce(1).write.mode("append").parquet(path)


def test_stream_of_runs_equals_batch(spark, tmp_path):
    source, table = f"{tmp_path}/in", StateTable(spark, f"{tmp_path}/state", SCHEMA)
    runs = [[("a", "f", "2026-01-01", True), ("b", "f", "2026-01-01", True), ("x", "g", "2026-01-01", True)], [("a", "f", "2026-01-02", True), (None, "g", "2026-01-02", False)], [("b", "f", "2026-01-03", True), ("a", "f", "2026-01-03", True)]]
    want = spark.createDataFrame([], SCHEMA)
    for run in runs:
        write(spark, run, source)
        stream = spark.readStream.schema("id string, feed string, day date, ok boolean").parquet(source)
        merge_stream(stream, table, f"{tmp_path}/cp", now=lambda b: F.lit(b.agg(F.max("day")).first()[0]), log=f"{tmp_path}/log").awaitTermination()
        batch = spark.createDataFrame(run, "id string, feed string, day string, ok boolean").withColumn("day", F.to_date("day"))
        merged = state.snapshot_merge(want, batch.filter("id IS NOT NULL").drop("ok"), batch.filter("ok").select("feed"), F.lit(run[0][2]).cast("date"))
        want = spark.createDataFrame(merged.drop("change").collect(), merged.drop("change").schema)
    got = table.latest().select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    log = spark.read.parquet(f"{tmp_path}/log")
    assert sorted((r.id, r.change) for r in log.collect()) == [("a", "new"), ("b", "back"), ("b", "gone"), ("b", "new"), ("x", "new")]


def test_health_over_a_stream(spark, tmp_path):
    hour = 3_600_000_000
    rows = [("f", True, 200, 5, 0), ("f", True, 200, 0, hour), ("f", True, 200, 0, 2 * hour), ("f", True, 200, 3, 3 * hour), ("g", False, 500, 0, 0), ("g", False, 500, 0, 25 * hour), ("g", False, 500, 0, 26 * hour)]
    spark.createDataFrame(rows, "id string, ok boolean, status long, count long, checked long").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, ok boolean, status long, count long, checked long").parquet(f"{tmp_path}/in")
    health_stream(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    got = sorted((r.id, r.checked // hour, r.since // hour, r.alert, r.raised) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    zero, dead = "yield dropped to zero", "failing for a day"
    assert got == [("f", 0, 0, None, False), ("f", 1, 1, zero, True), ("f", 2, 1, zero, False), ("f", 3, 3, None, False), ("g", 0, 0, None, False), ("g", 25, 0, dead, True), ("g", 26, 0, dead, False)]


def test_batch_health_keeps_a_line_that_is_not_modified(spark):
    previous = spark.sql("SELECT 'f' AS id, true AS ok, 200 AS status, 5 AS count, TIMESTAMP '2026-01-01' AS since, CAST(NULL AS STRING) AS alert")
    results = spark.sql("SELECT 'f' AS id, true AS ok, 304 AS status, 0 AS count, true AS not_modified, TIMESTAMP '2026-01-02' AS checked")
    r = state.health(previous, results).first()
    assert (r.status, r["count"], str(r.since), r.alert, r.raised) == (200, 5, "2026-01-01 00:00:00", None, False)

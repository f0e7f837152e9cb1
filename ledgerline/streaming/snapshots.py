"""State that a stream keeps: the same functions as in batch, one micro-batch at a time.

A micro-batch is a run: its rows are merged into the state table, which is written under the batch's number before the
pointer moves to it, so a batch that is repeated after a failure starts from the same state and writes the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.selection import keep_first
from ..operators.state import snapshot_merge


class StateTable:
    """Versions of a table in a folder that all executors see; version n is what batch n wrote."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _exists(self, version: int) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _versions(self) -> list[int]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True)

    def before(self, batch: int) -> DataFrame:
        """The state that batch ``batch`` starts from: the newest whole version of an earlier batch."""
        for v in self._versions():
            if v < batch and self._exists(v):
                return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={v}")
        return self.spark.createDataFrame([], self.schema)

    def latest(self) -> DataFrame:
        return self.before(1 << 62)

    def write(self, df: DataFrame, batch: int) -> None:
        """Writes version ``batch``, and removes those before the one that it started from: a repeated batch needs that one only."""
        whole = [v for v in self._versions() if v < batch and self._exists(v)]
        df.write.mode("overwrite").parquet(f"{self.path}/v={batch}")
        for v in whole[1:]:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={v}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def merge_stream(rows: DataFrame, table: StateTable, checkpoint: str, *, now: Callable[[DataFrame], Column], keep: tuple[str, ...] = (), log: str | None = None) -> StreamingQuery:
    """Merges each micro-batch (rows with ok, the feeds that ran) into the state table, and appends what changed to the
    log. Runs what is available and stops."""
    columns = [c for c in rows.columns if c != "ok"]

    def one(batch: DataFrame, n: int) -> None:
        if batch.isEmpty():
            return
        at = now(batch)
        # of several rows of one id always the same, so that a repeated batch writes the same table
        fresh = keep_first(batch.filter("id IS NOT NULL").select(*columns), ["id"], [F.col(c) for c in columns])
        merged = snapshot_merge(table.before(n), fresh, batch.filter("ok").select("feed"), at, keep=keep)
        state_columns = [c for c in merged.columns if c != "change"]
        table.write(merged.select(*state_columns), n)
        if log:  # a repeated batch replaces its own part of the log
            merged.filter("change IS NOT NULL").select("id", "feed", "change").withColumn("at", at).write.mode("overwrite").parquet(f"{log}/batch={n}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def health_stream(results: DataFrame, hours: float = 24.0) -> DataFrame:
    """(id, checked, since, alert, raised) for each result (id, ok, status, count, checked as microseconds) of a stream:
    the state of a feed is its last line, kept by Spark per key. ``results`` may be a batch frame too."""
    zero, dead = "yield dropped to zero", "failing for a day"

    def one(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        out = []
        for r in pd.concat(list(parts)).sort_values(["checked", "status", "n_rows"]).itertuples():
            some, now = r.n_rows > 0, int(r.checked)
            same = last is not None and (bool(last[0]), int(last[1]), last[2] > 0) == (bool(r.ok), int(r.status), some)
            since = int(last[3]) if same else now
            had, alert = (last[2] > 0, last[4]) if last else (False, "")
            new, raised = "", False
            if r.ok and not some and had:
                new, raised = zero, True
            elif r.ok and not some and alert == zero:
                new = zero
            elif not r.ok and now - since >= hours * 3.6e9:
                new, raised = dead, alert != dead
            last = (bool(r.ok), int(r.status), int(some), since, new)
            out.append((key[0], now, since, new or None, raised))
        state.update(last)
        yield pd.DataFrame(out, columns=["id", "checked", "since", "alert", "raised"])

    rows = results.select("id", "ok", "status", F.col("count").alias("n_rows"), "checked")

    key = results.schema["id"].dataType.simpleString()
    return rows.groupBy("id").applyInPandasWithState(one, f"id {key}, checked long, since long, alert string, raised boolean", "ok boolean, status long, some long, since long, alert string", "append", GroupStateTimeout.NoTimeout)

"""Documents and reviews as they are written: JSON and Markdown, index lines, patches, totals. All Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD = 2  # characters of an id that name its folder


def _cell(value: Column) -> Column:
    return F.replace(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " "), F.lit("|"), F.lit("\\|"))


def markdown(title: Column, facts: Column) -> Column:
    """A page with a table of the facts (array of name and value) that are known, in their order."""
    known = F.filter(facts, lambda f: f["value"].isNotNull() & (f["value"] != ""))
    rows = F.transform(known, lambda f: F.concat(F.lit("| "), _cell(f["name"]), F.lit(" | "), _cell(f["value"]), F.lit(" |")))
    table = F.when(F.size(known) > 0, F.concat(F.lit("\n| | |\n|---|---|\n"), F.array_join(rows, "\n"), F.lit("\n"))).otherwise("")
    return F.concat(F.lit("# "), _cell(title), F.lit("\n"), table)


def documents(df: DataFrame, id_: str, title: str, facts: str) -> DataFrame:
    """(id, shard, json, markdown) of each document; what is null is left out (K5)."""
    known = F.filter(F.col(facts), lambda f: f["value"].isNotNull())
    body = F.to_json(F.struct(F.col(id_).alias("id"), F.col(title).alias("title"), F.map_from_entries(known).alias("facts")))
    return df.select(F.col(id_).alias("id"), F.substring(F.col(id_), 1, SHARD).alias("shard"), body.alias("json"), markdown(F.col(title), F.col(facts)).alias("markdown"))


def write_documents(rows: DataFrame, path: str) -> None:
    """One folder for each shard, whole or not at all."""
    rows.write.mode("overwrite").partitionBy("shard").parquet(path)


def index_line(df: DataFrame, id_: str, status: str, pages: str, tables: str) -> DataFrame:
    """(id, line): what an index says of a document: its state, and its size only if it was read (K6)."""
    read = F.col(status) == "ok"
    line = F.struct(F.col(id_).alias("id"), F.col(status).alias("status"), F.when(read, F.col(pages)).alias("pages"), F.when(read & (F.col(tables) > 0), F.col(tables)).alias("tables"))
    return df.select(F.col(id_).alias("id"), F.to_json(line).alias("line"))


def review(changes: DataFrame, record: str, path: str = "path") -> DataFrame:
    """(record, changes, patch) of the material changes (before, after, kind, bookkeeping) of each record, path by path (K11). A
    record's paths make one row, as they make one page for its reader."""
    x = changes.filter((F.col("kind") != "unchanged") & ~F.col("bookkeeping"))
    line = lambda mark, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{mark} "), F.col(path), F.lit(": "), F.col(c)))
    lines = x.select(record, path, F.concat_ws("\n", line("-", "before"), line("+", "after")).alias("lines"))
    g = lines.groupBy(record).agg(F.array_sort(F.collect_list(F.struct(path, "lines"))).alias("all"))
    return g.select(record, F.size("all").cast("long").alias("changes"), F.array_join(F.transform("all", lambda c: c["lines"]), "\n").alias("patch"))


def totals(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, rows): how many there are of each kind and state, and of all."""
    return df.rollup(*by).agg(F.count("*").alias("rows"))


def standing(health: DataFrame, id_: str, alert: str, shown: int = 10) -> DataFrame:
    """(broken, first): how many carry an alert now, however long, and the first of them by name (A26). The names come from a
    top-k, so all ids never meet."""
    bad = health.filter(F.col(alert).isNotNull())
    few = bad.select(id_).orderBy(id_).limit(shown).agg(F.array_join(F.array_sort(F.collect_list(id_)), ", ").alias("first"))
    return bad.agg(F.count("*").alias("broken")).join(F.broadcast(few))


def grown(now: DataFrame, before: DataFrame, name: str, value: str, step: int = 1000) -> DataFrame:
    """(name, value): published counts, rounded down to ``step`` where they reach it, never less than what was published."""
    rounded = F.when(F.col(value) >= step, F.col(value) - F.col(value) % step).otherwise(F.col(value))
    x = now.select(name, rounded.alias(value)).join(before.select(name, F.col(value).alias("__before")), name, "left")
    return x.select(name, F.greatest(F.col(value), F.coalesce("__before", F.lit(0))).alias(value))

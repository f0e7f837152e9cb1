"""Tables and texts that are written: equal input gives equal files."""

from __future__ import annotations

from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, key: str) -> DataFrame:
    """(key, value): rows as JSON with their columns in order of name, nulls left out, in order of the key."""
    columns = sorted(df.columns)
    return df.select(F.col(key), F.to_json(F.struct(*columns)).alias("value")).orderBy(key)


def write_json_lines(df: DataFrame, key: str, path: str) -> None:
    """One folder of text files; Spark's commit makes it appear as a whole. Range partitions keep the order of the
    key across files, so no single task writes everything."""
    json_lines(df, key).select("value").write.mode("overwrite").text(path)


def append_changes(changes: DataFrame, path: str) -> None:
    """The change log, only ever appended to, by month."""
    changes.withColumn("month", F.date_format("at", "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)


def atom(rows: DataFrame, title: str, feed_id: str, most: int = 300) -> str:
    """A feed of the newest rows (id, url, title, entity, first_seen); at most ``most`` reach the driver."""
    top = rows.orderBy(F.desc("first_seen"), F.desc("id")).limit(most).collect()
    out = ['<?xml version="1.0" encoding="utf-8"?>', '<feed xmlns="http://www.w3.org/2005/Atom">', f"  <title>{escape(title)}</title>", f"  <id>{escape(feed_id)}</id>", f"  <updated>{top[0].first_seen if top else '1970-01-01'}</updated>"]
    for r in top:
        out.append(f"  <entry><id>urn:sha256:{r.id}</id><title>{escape(r.title[:300])}</title><link href={quoteattr(r.url)}/><updated>{r.first_seen}</updated><category term={quoteattr(r.entity)}/></entry>")
    return "\n".join([*out, "</feed>"]) + "\n"


def toml(value: dict, path: str = "") -> str:
    """TOML of nested dicts, lists and texts; booleans are refused, they are words here."""

    def one(v: object) -> str:
        if isinstance(v, bool):
            raise TypeError("write yes or no")
        if isinstance(v, list):
            return "[" + ", ".join(map(one, v)) + "]"
        return str(v) if isinstance(v, int | float) else '"' + str(v).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'

    tables = {k: v for k, v in value.items() if isinstance(v, dict) or isinstance(v, list) and v and all(isinstance(x, dict) for x in v)}
    lines = [f"{k} = {one(v)}" for k, v in value.items() if k not in tables]
    for k, v in tables.items():
        name = f"{path}.{k}" if path else k
        for x in [v] if isinstance(v, dict) else v:
            lines += ["", f"[{name}]" if isinstance(v, dict) else f"[[{name}]]", toml(x, name)]
    return "\n".join(lines)


def add_checked(table: DataFrame, new: DataFrame, check, path: str) -> DataFrame:
    """Writes table and new rows together if ``check`` finds nothing wrong with them, else nothing; returns what it
    found."""
    both = table.unionByName(new, allowMissingColumns=True)
    wrong = check(both)
    if not wrong.head(1):
        both.write.mode("overwrite").parquet(path)
    return wrong


def counts_table(df: DataFrame, names: dict[str, str]) -> str:
    """A table of text with one line for each named count, rounded down to thousands where it has them."""
    row = df.agg(*[F.expr(e).alias(n) for n, e in names.items()]).first()
    shown = lambda n: f"{n // 1000 * 1000:,}+" if n >= 1000 else str(n)
    return "\n".join(["| | |", "|---|---|", *[f"| {n} | {shown(row[n])} |" for n in names]])

"""Files of records: JSON lines, TOML catalogues, records with front matter."""

from __future__ import annotations

import json
import tomllib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jsonl(spark: SparkSession, path: str, schema: str, comments: bool = False) -> DataFrame:
    """One object a line; only \\n ends a line. With ``comments``, lines that begin with # and empty ones are skipped."""
    if not comments:
        return spark.read.schema(schema).option("lineSep", "\n").json(path)
    lines = spark.read.option("lineSep", "\n").text(path).filter(~F.col("value").rlike(r"^\s*(#|$)"))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def _plain(value: object) -> object:
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def toml_entities(spark: SparkSession, path: str) -> DataFrame:
    """(kind, id, json, file) of every table of every list of the TOML files of a folder; doubles are kept, for lint."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for file, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for kind, rows in tomllib.loads(content.decode()).items():
                    out += [(kind, str(r.get("id", "")), json.dumps(r, sort_keys=True, default=_plain), file) for r in rows if isinstance(rows, list) and isinstance(r, dict)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in range(4)], names=["kind", "id", "json", "file"])

    return files.mapInArrow(run, "kind string, id string, json string, file string")


def front_matter(spark: SparkSession, path: str) -> DataFrame:
    """(slug, json, body, error) of text files that begin with TOML between +++ fences; a file that cannot be read is
    a row with its error, not a failed job."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]*?)(\.[^./]*)?$", 1).alias("slug"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                parts = (text or "").split("+++", 2)
                try:
                    if len(parts) < 3 or parts[0].strip():
                        raise ValueError("no closed front matter")
                    out.append((json.dumps(tomllib.loads(parts[1]), sort_keys=True, default=_plain), parts[2].lstrip("\n"), None))
                except ValueError as e:
                    out.append((None, None, str(e)))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([x[i] for x in out], pa.string()) for i in range(3)]], names=["slug", "json", "body", "error"])

    return files.mapInArrow(run, "slug string, json string, body string, error string")


def flatten(df: DataFrame, key: str, json_column: str) -> DataFrame:
    """(key, path, value) of nested JSON; a list is one value unless its elements are tables; windows (from and to)
    are one value "from / to"."""
    kind = df.schema[key].dataType.simpleString()

    def leaves(value: object, path: str) -> Iterator[tuple[str, str]]:
        if isinstance(value, dict):
            if value and set(value) <= {"from", "to", "status"}:
                yield path, " / ".join(str(value.get(k, "")) for k in ("from", "to") if k in value)
            else:
                for k in value:
                    yield from leaves(value[k], f"{path}.{k}" if path else k)
        elif isinstance(value, list) and any(isinstance(x, dict) for x in value):
            for i, x in enumerate(value):
                yield from leaves(x, f"{path}[{i}]")
        else:
            yield path, ", ".join(map(str, value)) if isinstance(value, list) else str(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, out = [], []
            for k, text in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                for leaf in leaves(json.loads(text), "") if text else ():
                    keys.append(k.as_py())
                    out.append(leaf)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), *[pa.array([x[i] for x in out], pa.string()) for i in range(2)]], names=[key, "path", "value"])

    return df.select(key, json_column).mapInArrow(run, f"{key} {kind}, path string, value string")

"""Classes that texts name, by a vocabulary whose classes and spellings may hold in some places only.

The vocabulary is a list of rules, a parameter of some hundred entries. A text's classes depend on how the matches of all rules
overlap, so this is Python over one text each, by Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

# A name ends where letters and digits do, and not in front of a mark of a subclass ("-A", "-II", "-2").
ENDS = r"(?![A-Za-z0-9])(?!\s*-\s*(?:[A-Za-z]|[IVX]{1,3}|\d)(?![A-Za-z0-9]))"
#: The axis of a class that stands for everyone: beside another class it says nothing.
EVERYONE = "all"


@dataclass(frozen=True)
class Spelling:
    """A class, a pattern that names it, where it is used (None: everywhere), and whether case matters."""

    name: str
    pattern: str
    places: frozenset[str] | None = None
    exact: bool = False
    axis: str = ""


def spellings(table: dict) -> list[Spelling]:
    """The spellings of a vocabulary file: classes with aliases and codes, and further aliases of classes (S3)."""
    axes = {c["id"]: c.get("axis", "") for c in table.get("class", [])}
    out = []
    for entry in (*table.get("class", []), *table.get("alias", [])):
        name = entry.get("id") or entry["to"]
        places = frozenset(entry["jurisdictions"]) if entry.get("jurisdictions") else None
        out += [Spelling(name, p, places, exact, axes.get(name, "")) for exact, key in ((False, "aliases"), (True, "codes")) for p in entry.get(key, [])]
    return out


def problems(table: dict) -> list[str]:
    """What is wrong with a vocabulary: ids used twice, aliases of no class, patterns that do not compile."""
    ids = [c["id"] for c in table.get("class", [])]
    out = [f"class {i!r} is there twice" for i in dict.fromkeys(ids) if ids.count(i) > 1]
    out += [f"alias of {a['to']!r}, which is no class" for a in table.get("alias", []) if a["to"] not in ids]
    for s in spellings(table):
        try:
            re.compile(s.pattern)
        except re.error as e:
            out.append(f"{s.name!r}: {s.pattern!r}: {e}")
    return out


@cache
def _compiled(pattern: str, exact: bool) -> re.Pattern[str]:
    return re.compile(f"(?<![A-Za-z0-9])(?:{pattern}){ENDS}", 0 if exact else re.I)


def named(text: str, known: Iterable[Spelling], place: str | None = None) -> list[str]:
    """The classes that a text names, in the order in which it first names them. From left to right the next match counts, of
    those that begin there the longest, of equal ones that of the place."""
    rules = [(_compiled(s.pattern, s.exact), s, i) for i, s in enumerate(known) if s.places is None or place in s.places]
    found: dict[str, str] = {}
    at = 0
    while True:
        hits = [(m.start(), -m.end(), s.places is None, i, s) for p, s, i in rules if (m := p.search(text, at)) and m.end() > m.start()]
        if not hits:
            break
        _, end, _, _, s = min(hits, key=lambda h: h[:4])
        found.setdefault(s.name, s.axis)
        at = -end
    return [c for c, axis in found.items() if axis != EVERYONE or len(found) == 1]


def with_classes(df: DataFrame, key: str, text: str, place: str, known: list[Spelling]) -> DataFrame:
    """(key, classes, single): the classes that texts name in their place, and the one if it is one (M6)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [named(t or "", known, p) for t, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            single = [c[0] if len(c) == 1 else None for c in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string())), pa.array(single, pa.string())], names=[key, "classes", "single"])

    return df.select(key, text, place).mapInArrow(run, f"{key} {kind}, classes array<string>, single string")

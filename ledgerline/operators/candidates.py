"""Values of fields in running text: candidates with their evidence, by rules over clauses.

A rule is a label and the kind of value that belongs to it. A value belongs to the nearest label before it in the
clause, never past the next label; else to the label in the cell above it; else to the label of a clause without a value just above. The weight of a candidate
is that of its rule and of how near it stands to the label. Months are notes, and hedged texts give provisional dates.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.values import NEAR, NEAR_UP_TO
from .tables import amounts, days


@dataclass(frozen=True)
class Rule:
    field: str
    label: str
    kind: str  # day, reference (a day that others are counted from), int, money, text
    weight: float = 0.6


# Fields by the words before their values.
RULES = (
    Rule("payment_deadline", r"(?:last|closing)\s+date\s+(?:of|for|to)\s+(?:make\s+)?(?:online\s+)?(?:fee\s+)?(?:payment|pay\b|deposit)(?:\s+of\s+(?:the\s+)?fees?)?|fee\s+payment\s+(?:closes|ends|up\s*to|till)", "day", 0.8),
    Rule("age_as_on", r"\bage\b[^.;]{0,40}?\bas\s+on\b|crucial\s+date|cut[\s-]?off\s+date\s+for\s+(?:the\s+)?age", "reference", 0.8),
    Rule("admit_card_to", r"(?:admit\s+card|hall\s+ticket)s?\b[^.;]{0,60}?\b(?:up\s*to|until|till)", "day", 0.65),
    Rule("registration_open", r"(?:opening|starting|commencement)\s+(?:date\s+)?(?:of|for)?\s*(?:online\s+)?(?:application|registration)|(?:apply|registration)\s+(?:opens|starts|from)", "day", 0.8),
    Rule("registration_deadline", r"(?:last|closing)\s+date(?:\s+\w+){0,6}|apply\s+(?:on\s+or\s+)?before|deadline", "day", 0.85),
    Rule("exam_date", r"(?:date\s+of\s+)?(?:written\s+)?(?:exam(?:ination)?|test)(?:\s+(?:date|on|will be held on|is scheduled on))", "day", 0.75),
    Rule("admit_card", r"admit\s+card|hall\s+ticket", "day", 0.7),
    Rule("result", r"(?:declaration\s+of\s+)?results?\b", "day", 0.6),
    Rule("vacancies", r"(?:total\s+)?(?:no\.?\s+of\s+)?(?:vacanc\w+|posts?)\b\s*(?:is|are|:|-)?", "int", 0.7),
    Rule("fee", r"(?:application|exam(?:ination)?)?\s*fees?\b", "money", 0.7),
    Rule("age_max", r"(?:maximum|upper)\s+age(?:\s+limit)?|not\s+(?:more|older)\s+than", "int", 0.6),
    Rule("age_min", r"minimum\s+age|not\s+(?:less|younger)\s+than", "int", 0.6),
    Rule("pay_level", r"pay\s+level|level\s*-", "int", 0.6),
    Rule("pay", r"pay\s+(?:scale|band|matrix)|(?:consolidated\s+)?(?:salary|remuneration|emoluments?)", "money", 0.6),
    Rule("duration", r"duration", "text", 0.5),
    Rule("venue", r"(?:exam(?:ination)?|test)\s+(?:centres?|centers?|cit(?:y|ies))|venue", "text", 0.5),
    Rule("eligibility", r"(?:essential|educational|minimum)\s+qualifications?|eligibility(?:\s+criteria)?", "text", 0.5),
    Rule("mode", r"mode\s+of\s+(?:exam(?:ination)?|test|application)", "text", 0.5),
    Rule("negative_marking", r"negative\s+mark(?:s|ing)", "text", 0.5),
)
BELOW = -0.1  # what a value in the next clause or row weighs less
HEDGES = r"tentative|likely|provisional|expected|subject\s+to\s+change|may\s+be"
REFERENCE = r"\b(?:dated|dt\.?|as\s+on|vide|ref(?:erence)?\.?)\s*[:\-]?\s*$"
_MONTH = re.compile(r"\b(january|february|march|april|may|june|july|august|september|october|november|december)[,\s]+(20\d\d)\b", re.I)
_DAY_TEXT = re.compile(r"\d{1,2}[./-]\d{1,2}[./-]20\d\d|\d{1,2}(?:st|nd|rd|th)?\s+[A-Za-z]{3,9}\.?,?\s+20\d\d|20\d\d-\d\d-\d\d", re.I)
#: Looks of letters that scanners confuse, after NFKC.
_FOLD = str.maketrans({"‐": "-", "‑": "-", "–": "-", "—": "-", "’": "'", "‘": "'", "“": '"', "”": '"', " ": " "})


def normal(text: str) -> str:
    return "\n".join(" ".join(line.split()) for line in unicodedata.normalize("NFKC", text).translate(_FOLD).split("\n"))


def unwrapped(text: str) -> str:
    """Lines that a fixed width has cut are one again: a line goes on if it is long, ends without a mark and the next
    begins in lower case; cells of tables stay apart."""
    out: list[str] = []
    for line in text.split("\n"):
        if out and len(out[-1]) >= 60 and not re.search(r"[.:;|]$", out[-1]) and re.match(r"[a-z(]", line) and " | " not in line:
            out[-1] += " " + line
        else:
            out.append(line)
    return "\n".join(out)


def clauses(text: str) -> list[str]:
    return [c for line in text.split("\n") for c in (x.strip() for x in re.split(r";|(?<=[a-z)])\.\s+(?=[A-Z])", line)) if c]


def _values(clause: str, kind: str) -> Iterator[tuple[int, int, str, str]]:
    """(first, end, value, granularity) of the values of a kind."""
    if kind == "reference":
        yield from ((m.start(), m.end(), d[0], "day") for m in _DAY_TEXT.finditer(clause) if (d := days(m[0])))
    elif kind == "day":
        for m in _DAY_TEXT.finditer(clause):
            if (d := days(m[0])) and not re.search(REFERENCE, clause[max(0, m.start() - 40) : m.start()], re.I):
                yield m.start(), m.end(), d[0], "day"
        for m in _MONTH.finditer(clause):
            if not re.search(r"\d{1,2}(?:st|nd|rd|th)?\s*$", clause[: m.start()]):
                yield m.start(), m.end(), f"{m[1].title()} {m[2]}", "month"
    elif kind == "money":
        for m in re.finditer(r"(?:rs\.?|inr|₹)\s*[\d,]+|\b(?:nil|exempted)\b", clause, re.I):
            yield m.start(), m.end(), str((amounts(m[0]) or [0])[0]), "value"
    elif kind == "int":
        for m in re.finditer(r"(?<![\d./-])\d[\d,]*(?![\d./-]*\d)", clause):
            yield m.start(), m.end(), m[0].replace(",", ""), "value"
    else:
        m = re.search(r"[:\-]\s*(.{2,80})$", clause)
        if m:
            yield m.start(1), m.end(1), m[1].strip(" ."), "value"


@lru_cache(maxsize=8)
def _compiled(rules: tuple[Rule, ...]) -> tuple[re.Pattern[str], list[tuple[re.Pattern[str], Rule]]]:
    """What any label looks like, and each."""
    return re.compile("|".join(f"(?:{r.label})" for r in rules), re.I), [(re.compile(r.label, re.I), r) for r in rules]


def labels(clause: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, Rule]]:
    """(first, end, rule) of the labels of a clause, in its order; where two overlap, that of the rule named first."""
    anything, each = _compiled(rules)
    out: list[tuple[int, int, Rule]] = []
    if anything.search(clause):
        for p, r in each:
            if (m := p.search(clause)) and all(m.end() <= a or b <= m.start() for a, b, _ in out):
                out.append((m.start(), m.end(), r))
    return sorted(out, key=lambda x: x[:2])


def find(text: str, rules: tuple[Rule, ...] = RULES) -> list[dict]:
    """Candidates of a text, in its order. The value of a label is the first one behind it in its clause, before the next label; of a
    label without one in the cell of a table row, that of the cell below; of another, that of the next clause."""
    text = unwrapped(normal(text))
    tentative = bool(re.search(r"tentative\s+(?:schedule|dates?|calendar)", text, re.I))
    out: list[dict] = []
    above: Rule | None = None
    cells_above: dict[int, Rule] = {}
    width = 0

    def add(rule: Rule, value: tuple[int, int, str, str], weight: float, clause: str, ambiguous: bool = False) -> None:
        hedge = tentative or bool(re.search(HEDGES, clause, re.I))
        out.append({"field": rule.field, "value": value[2], "hint": round(rule.weight + weight, 2), "granularity": value[3], "provisional": hedge, "ambiguous": ambiguous, "evidence": clause})

    for clause in clauses(text):
        cells = [c.strip() for c in clause.strip("| ").split("|")] if "|" in clause else []
        below = cells_above if len(cells) == width else {}
        for column, rule in below.items():
            if value := next(_values(cells[column], rule.kind), None):
                add(rule, value, BELOW, clause)
        found = labels(clause, rules)
        if not found and above and not below and above.kind != "text" and (value := next(_values(clause, above.kind), None)):
            add(above, value, BELOW, clause)
        crowded = sum(1 for _ in _values(clause, "day")) >= 3
        paired = False
        for i, (_, end, rule) in enumerate(found):
            stop = found[i + 1][0] if i + 1 < len(found) else len(clause)
            value = next((v for v in _values(clause, rule.kind) if end <= v[0] < stop), None)
            if value:
                paired = True
                add(rule, value, NEAR[bisect_left(NEAR_UP_TO, value[0] - end)], clause, crowded and rule.kind == "day")
        cells_above, width = {}, len(cells)
        if cells and found and not paired:
            named = [(column, labels(c, rules)) for column, c in enumerate(cells)]
            cells_above = {column: x[-1][2] for column, x in named if x and x[-1][2].kind != "text"}
        above = found[-1][2] if found and not paired and not cells_above else None
    return out


def candidates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, field, value, hint, granularity, provisional, ambiguous, evidence) of all texts."""
    kind = df.schema[key].dataType.simpleString()
    names = ("field", "value", "hint", "granularity", "provisional", "ambiguous", "evidence")
    kinds = (pa.string(), pa.string(), pa.float64(), pa.string(), pa.bool_(), pa.bool_(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, order, out = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for i, c in enumerate(find(t or "")):
                    keys.append(k)
                    order.append(i)
                    out.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(order, pa.int32()), *[pa.array([c[n] for c in out], t) for n, t in zip(names, kinds, strict=True)]], names=[key, "ord", *names])

    return df.select(key, text).mapInArrow(run, f"{key} {kind}, ord int, field string, value string, hint double, granularity string, provisional boolean, ambiguous boolean, evidence string")

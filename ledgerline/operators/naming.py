"""Names: series that titles mention, short titles, ids that stay unique, headings."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that stand after a series' name, words in front of it that are not its own, words that open and
# close what a name may be part of, and words that are no name of their own.
HEADS = ("entrance test", "eligibility test", "examination", "exam", "test", "recruitment", "admission")
LEADS = frozenset("the of final provisional revised online notification notice result schedule advertisement corrigendum".split())
LEAD_PAIRS = frozenset(("admit card", "answer key"))
OPENERS = frozenset("for in regarding about towards under on".split())
CLOSERS = frozenset("in under at on for".split())
GENERIC = frozenset("online offline written main mains preliminary prelims final computer based common joint annual state national departmental competitive recruitment exam examination test entrance admission".split())
NO_SERIES = frozenset("PDF JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC FAQ FAQS RTI URL HTML ONLINE OFFLINE ADVT ITI NCC NSS".split())
FILLER = r"(?i)\b(recruitment\s+(of|to|for)|for\s+the\s+posts?\s+of|notification\s+for|advertisement\s+for|examination\s+for|direct\s+recruitment|posts?\s+of|the)\b"


def _own_words(words: list[str]) -> list[str]:
    """A run of words without years, and without what only leads up to a name."""
    run = [w.strip(".,-–:;/&'") for w in words]
    run = [w for w in run if w and not re.fullmatch(r"(?:19|20)\d\d(?:[-–/]\d{2,4})?", w)]
    while run:
        if " ".join(run[:2]).lower() in LEAD_PAIRS:
            del run[:2]
        elif run[0].lower() in LEADS:
            del run[0]
        else:
            break
    return run


def _is_name(run: list[str]) -> bool:
    """Two words or more that are not all generic, or one acronym that names a series."""
    plain = [w for part in run for w in re.findall("[a-z]+", part.lower())]
    if not plain or GENERIC.issuperset(plain):
        return False
    if len(plain) > 1:
        return sum(map(len, plain)) + len(plain) > 6
    return len(run[0]) > 2 and run[0].isupper() and run[0] not in NO_SERIES


def series(title: str) -> list[tuple[str, str]]:
    """(name, head) of the series that a title names: the words up to a head word, the posts that are recruited for, acronyms in
    front of a year. A name does not reach over a word that opens a phrase, or over a comma."""
    words = title.replace("_", " ").split()
    low = [w.lower().strip(".,;:()") for w in words]
    ends = [w[-1] in ",;:|" for w in words]
    heads, posts, acronyms = [], [], []
    first, at = 0, 0  # where the run that may be a name begins
    while at < len(words):
        head = next((h for h in HEADS if low[at : at + h.count(" ") + 1] == h.split()), None)
        if head and at > first:
            heads.append((words[first:at], head))
        if low[at] in ("post", "posts") and low[at + 1 : at + 2] == ["of"]:
            stop = next((i for i in range(at + 2, len(words)) if low[i] in CLOSERS or words[i][0] == "("), len(words))
            stop = next((i + 1 for i in range(at + 2, stop) if ends[i]), stop)
            posts.append((words[at + 2 : stop], "recruitment"))
        joined = re.fullmatch(r"([A-Z]{3,10})(?:-20\d\d)?\W*", words[at])
        if joined and ("-" in words[at] or re.match(r"20\d\d\b", " ".join(words[at + 1 : at + 2]))):
            acronyms.append(([joined[1]], "acronym"))
        step = head.count(" ") + 1 if head else 1
        if head or low[at] in OPENERS or any(ends[at : at + step]):
            first = at + step
        at += step
    out: dict[str, tuple[str, str]] = {}
    for run, head in (*heads, *posts, *acronyms):
        own = _own_words(run)
        if _is_name(own):
            out.setdefault(" ".join(own).lower(), (" ".join(own), head))
    return list(out.values())


def series_names(df: DataFrame, key: str, title: str) -> DataFrame:
    """(key, name, head) for every series that a title names."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, out = [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for s in series(t or ""):
                    keys.append(k)
                    out.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), *[pa.array([x[i] for x in out], pa.string()) for i in range(2)]], names=[key, "name", "head"])

    return df.select(key, title).mapInArrow(run, f"{key} {kind}, name string, head string")


def short_title(catalogue: Column, aliases: Column, official: Column, body: Column, cycle: Column, most: int = 48) -> Column:
    """The catalogue's short name, else the shortest alias that fits, else the official title without filler behind the
    body's name; with the cycle, where the title has none; at most so long."""
    fits = F.filter(aliases, lambda a: F.length(a) <= most)
    shortest = F.get(F.filter(fits, lambda a: F.length(a) == F.array_min(F.transform(fits, lambda x: F.length(x)))), F.lit(0))
    bare = F.regexp_replace(F.regexp_replace(official, r"\b(19|20)[0-9]{2}(-[0-9]{2,4})?\b", " "), FILLER, " ")
    bare = F.trim(F.regexp_replace(F.regexp_replace(bare, r"\([^)]*\)?", " "), r"\s+", " "))
    doubled = F.regexp_replace(F.concat_ws(" ", body, bare), r"(?i)\b(\w+)(\s+\1\b)+", "$1")
    name = F.coalesce(catalogue, shortest, doubled)
    year = F.regexp_extract(F.coalesce(cycle, F.lit("")), r"^[0-9]{4}(-[0-9]{2})?", 0)
    dated = F.when((year != "") & ~F.contains(name, F.substring(year, 1, 4)), F.concat_ws(" ", name, year)).otherwise(name)
    return F.rtrim(F.substring(dated, 1, most))


def unique_stems(df: DataFrame, id_: str) -> DataFrame:
    """Rows with ``stem``: the id without its prefix, where that is unique in the batch (X25). The numbers come from an
    aggregate, so a stem that many share is no hot group."""
    x = df.withColumn("__bare", F.regexp_replace(F.col(id_), "^[^-]*-", ""))
    n = x.groupBy("__bare").agg(F.count("*").alias("__n"))
    return x.join(n, "__bare").withColumn("stem", F.when(F.col("__n") == 1, F.col("__bare")).otherwise(F.col(id_))).drop("__bare", "__n")


def heading(page: Column) -> Column:
    """The first heading of a page: a numbered clause, else a line in capitals, else a section."""
    head = F.substring(page, 1, 4000)
    tidy = lambda p: F.substring(F.trim(F.regexp_replace(F.regexp_extract(head, p, 0), r"\s+", " ")), 1, 80)
    tried = [tidy(p) for p in (r"(?im)^\s*[0-9]{1,2}(\.[0-9]{1,2})*[.)]?\s+[A-Z][A-Za-z/ &()-]{3,60}\s*$", r"(?m)^\s*[A-Z][A-Z0-9 /&-]{5,60}\s*$", r"(?im)^\s*SECTION\s+[0-9]+[^\n]{0,60}")]
    return F.coalesce(*[F.when(t != "", t) for t in tried])


def file_date_hint(name: Column, anchor: Column) -> Column:
    """A date or year that a file name shows: a hint for sorting, never a value."""
    full = r"(?<![0-9])([0-9]{4}|[0-9]{1,2})[._-]([0-9]{1,2})[._-]([0-9]{4}|[0-9]{1,2})(?![0-9])"
    a, b, c = (F.regexp_extract(name, full, i).try_cast("int") for i in (1, 2, 3))
    year = F.regexp_extract(name, r"(?<![0-9])(20[0-9]{2})(?![0-9])", 1)
    said = F.regexp_extract(anchor, r"(?<![0-9])(20[0-9]{2})(?![0-9])", 1)
    return F.coalesce(F.when(a > 31, F.format_string("%04d-%02d-%02d", a, b, c)).when(c > 31, F.format_string("%04d-%02d-%02d", c, b, a)).when(b <= 12, F.format_string("%02d-%02d", a, b)), F.when(year != "", year), F.when(said != "", said))


def scan_language(jurisdiction: Column, languages: dict[str, str], otherwise: str = "eng") -> Column:
    """The languages to read a scan of a place with."""
    out = F.lit(otherwise)
    for place, lang in languages.items():
        out = F.when(jurisdiction == place, f"{lang}+{otherwise}").otherwise(out)
    return out


def numbered(df: DataFrame, by: str, order: list[Column]) -> DataFrame:
    return df.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy(*order)))

"""Text columns: titles, kinds, phrases, scripts, clauses, and scores of words against a query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What notice boards put beside a title.
NOISE = r"(?i)\(?\s*[0-9]+(\.[0-9]+)?\s*(kb|mb|kib|mib|bytes)\s*\)?|\b(click\s*here|new!?|pdf\s*icon)\b|\b(pdf\s*file|external\s*site|link)\s*that\s*opens\s*in\s*a\s*(new\s*)?window\.?"
EDGES = " \t\r\n-–|:•·❯❮›»�"


def collapse(text: Column) -> Column:
    """White space to one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def clean_title(text: Column) -> Column:
    """A title without sizes, "click here" and marks at its ends. White space goes first, which keeps it linear."""
    bare = collapse(F.regexp_replace(collapse(text), NOISE, " "))
    return F.btrim(bare, F.lit(EDGES))


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: str | None = "other") -> Column:
    """The name of the first rule (name, pattern) that matches."""
    out = None
    for name, pattern in rules:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def kind_of(title: Column, first_page: Column, kinds: list[tuple[str, str]], otherwise: str = "other") -> Column:
    """The kind that a title names, else the one that the first page does."""
    return F.coalesce(first_match(title, kinds, None), first_match(first_page, kinds, otherwise))


def keep(title: Column, url: Column, *, include: str | None, exclude: str | None, scoped: bool, navigation: str, document: str, notice: str) -> Column:
    """Whether a link of a listing is a notice. ``include`` decides alone if given; else navigation words go unless
    they lead to a document, and of an unscoped listing only documents and links that name a notice stay. What
    ``exclude`` matches goes."""
    hay = F.concat_ws(" ", title, url)
    if include:
        out = hay.rlike(include)
    else:
        out = ~title.rlike(navigation) | url.rlike(document)
        if not scoped:
            out = out & (url.rlike(document) | title.rlike(notice) | url.rlike(notice))
    return out & ~hay.rlike(exclude) if exclude else out


def phrase_pattern(name: str) -> str:
    """A pattern for a name whose words may be joined by marks or run together, not part of a longer word."""
    import re

    found = re.findall(r"[A-Za-z0-9]+", name)
    return r"(?i)(^|[^A-Za-z])(" + r"[\s\-_./()]*".join(found) + r")([^A-Za-z]|$)" if found else r"a^"


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))


def clip(text: Column, most: int) -> Column:
    """At most so many characters, ended at a word."""
    cut = F.regexp_replace(F.substring(text, 1, most + 1), r"\s+\S*$", "")
    return F.when(F.length(text) <= most, text).otherwise(F.rtrim(F.substring(cut, 1, most)))


def share_of(text: Column, pattern: str) -> Column:
    """The share of a text's characters, white space apart, that match a one-character pattern."""
    solid = F.length(F.regexp_replace(text, r"\s", ""))
    return F.when(solid > 0, F.regexp_count(text, F.lit(pattern)) / solid).otherwise(F.lit(0.0))


# The first digit of each Indic script, and the months as Hindi and Marathi spell them.
ZEROS = "०০੦૦୦௦౦೦൦"
INDIC_MONTHS = {
    "January": "जनवरी जानेवारी", "February": "फरवरी फेब्रुवारी", "March": "मार्च", "April": "अप्रैल एप्रिल", "May": "मई मे", "June": "जून", "July": "जुलाई जुलै", "August": "अगस्त ऑगस्ट",
    "September": "सितंबर सितम्बर सप्टेंबर", "October": "अक्तूबर अक्टूबर ऑक्टोबर", "November": "नवंबर नवम्बर नोव्हेंबर", "December": "दिसंबर दिसम्बर डिसेंबर",
}


def ascii_digits(text: Column) -> Column:
    """Digits of Indic scripts as ASCII ones."""
    return F.translate(text, "".join(chr(ord(z) + i) for z in ZEROS for i in range(10)), "0123456789" * len(ZEROS))


def western_dates(text: Column) -> Column:
    """Indic digits and Devanagari month names as ASCII digits and English months; a text of ASCII only stays as it is."""
    out = ascii_digits(text)
    for month, spelled in INDIC_MONTHS.items():
        out = F.regexp_replace(out, f"(?<![\u0900-\u097F])(?:{'|'.join(spelled.split())})(?![\u0900-\u097F])", month)
    return F.when(text.rlike("[^\\x00-\\x7F]"), out).otherwise(text)


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def clauses(text: Column) -> Column:
    """Lines, cut at semicolons and after sentences."""
    return F.filter(F.transform(F.split(text, r"\n|;|\.\s"), lambda c: F.trim(c)), lambda c: c != "")


def query_terms(query: str) -> list[str]:
    import re

    return list(dict.fromkeys(t for t in (x.strip(".-") for x in re.split(r"[\s,;]+", query.lower())) if t))


def tolerance(length: int) -> int:
    """How many letters a query of so many may be off."""
    return 0 if length <= 2 else 1 if length <= 4 else 2 if length <= 9 else 3


def term_score(hay: Column, term: str) -> Column:
    """1 for a whole word, 2 for part of the text, 3 for its first words or the start of a word, 4 for about a word,
    -1 for none; ``hay`` in lower case."""
    parts = F.split(hay, "[^a-z0-9]+")
    allow = tolerance(len(term))
    about = lambda w: (F.abs(F.length(w) - len(term)) <= allow) & (F.levenshtein(w, F.lit(term)) <= allow)
    near = (F.exists(parts, lambda w: (w != "") & about(w)) | about(hay)) if allow else F.lit(False)
    runs = F.exists(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), " ") == term)
    return (
        F.when(F.array_contains(parts, term), 1)
        .when(F.contains(hay, F.lit(term)), 2)
        .when(runs | F.exists(parts, lambda w: F.startswith(w, F.lit(term))), 3)
        .when(near, 4)
        .otherwise(-1)
    )


def query_score(hay: Column, query: str) -> Column:
    """The best score of any term of a query; 0 for an empty query, -1 for none."""
    scores = [term_score(hay, t) for t in query_terms(query)]
    if not scores:
        return F.lit(0)
    if len(scores) == 1:
        return scores[0]
    return F.coalesce(F.array_min(F.filter(F.array(*scores), lambda s: s > 0)), F.lit(-1))


def windows(text: Column, size: int, step: int) -> Column:
    """(n, text) of overlapping pieces."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - size + step - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda s, i: F.struct(i.alias("n"), F.substr(text, s + 1, F.lit(size)).alias("text")))

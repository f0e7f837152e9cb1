"""Facts in sentences: ages, relaxations, qualifications, stages, pay, adverts, links. All Column expressions over
clauses or whole texts; a clause is a row, so that what was found carries its evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .candidates import HEDGES
from .tables import CLASSES, EVENTS

# Words of clauses that state something else than the fact sought, and ordered levels and stages.
AGE_NOISE = r"(?i)relax|concession|cumulative|children|spouse|\bsons?\b|daughters?|\bward\b|dependent|widow|retire|superannuation|service\s+of|served"
AGE_MIN, AGE_MAX = (14, 60), (16, 70)  # what a lower and an upper limit can be
HEADING = 60  # characters of a clause that may head the next one
LEVELS = [("Doctorate", r"(?i)\bph\.?\s*d\b|doctorate"), ("Postgraduate", r"(?i)post[\s-]*graduat|master'?s?\s+degree|\bm\.?(sc|tech|com)\b|\bmba\b"), ("Graduate", r"(?i)\bgraduat|bachelor'?s?\s+degree|\bdegree\b|\bb\.?(sc|tech|com)\b|\bmbbs\b"), ("Diploma / ITI", r"(?i)\bdiploma\b|\biti\b"), ("Class 12", r"(?i)\b10\s*\+\s*2\b|\b12th\b|intermediate|higher\s+secondary"), ("Class 10", r"(?i)\b10th\b|matricul|high\s+school")]
STAGES = [("Written examination", r"(?i)written\s+(exam|test)"), ("Skill test", r"(?i)skill\s+test|typing\s+test"), ("Physical test", r"(?i)physical\s+(efficiency|measurement|standard)?\s*test"), ("Group discussion", r"(?i)group\s+discussion"), ("Interview", r"(?i)interview|personality\s+test|viva"), ("Document verification", r"(?i)document\s+verification"), ("Medical examination", r"(?i)medical\s+(exam|test|fitness)")]


def clause_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, clause, before): a row for each clause, with the clause above it."""
    x = df.select(key, tx.clauses(F.col(text)).alias("__c"))
    return x.select(key, F.posexplode("__c").alias("at", "clause"), "__c").withColumn("before", F.when(F.col("at") > 0, F.get(F.col("__c"), F.col("at") - 1)).otherwise("")).drop("__c")


def ages(rows: DataFrame) -> DataFrame:
    """Clauses that state an age limit, as age_min and age_max; a limit that no post has, or one upside down, is none."""
    c = F.col("clause")
    named = lambda x: x.rlike(r"(?i)\bage\b")
    asked = named(c) | named(F.when(F.length("before") < HEADING, F.col("before")).otherwise(""))
    num = lambda p, i: F.regexp_extract(c, p, i).try_cast("int")
    span = r"(?i)([0-9]{2})\s*(years?\s*)?(and|to|-|–)\s*([0-9]{2})\s*years?"
    low = F.coalesce(num(span, 1), num(r"(?i)(minimum\s+age|not\s+(be\s+)?less\s+than|at\s+least)[^0-9]{0,40}?([0-9]{2})\s*years?", 3))
    high = F.coalesce(num(span, 4), num(r"(?i)(maximum\s+age|upper\s+age\s+limit|not\s+(be\s+)?(more\s+than|exceed\w*|above)|below|under)[^0-9]{0,40}?([0-9]{2})\s*years?", 4))
    x = rows.filter(asked & ~c.rlike(AGE_NOISE)).withColumns({"age_min": F.when(low.between(*AGE_MIN), low), "age_max": F.when(high.between(*AGE_MAX), high)})
    return x.filter((F.col("age_min").isNotNull() | F.col("age_max").isNotNull()) & ~F.coalesce(F.col("age_min") >= F.col("age_max"), F.lit(False)))


def classes(text: Column) -> Column:
    """The reservation classes that a text names, in a fixed order."""
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?i){p}"), F.lit(c)) for c, p in CLASSES.items()]))


def relaxations(rows: DataFrame) -> DataFrame:
    """Clauses that relax an age limit: years and for whom."""
    years = F.regexp_extract("clause", r"(?i)([0-9]{1,2})\s*(\(\s*\w+\s*\)\s*)?years?", 1)
    x = rows.filter(F.col("clause").rlike("(?i)relax|concession")).withColumns({"years": years.try_cast("int"), "categories": F.array_remove(classes(F.col("clause")), "Unreserved")})
    return x.filter(F.col("years").between(1, 15) & (F.size("categories") > 0))


def levels(text: Column) -> Column:
    """The levels of education that a text asks for, highest first."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in LEVELS]))


def stages(text: Column) -> Column:
    """Stages of selection in the order in which a text first names them."""
    found = F.array(*[F.struct(F.coalesce(F.regexp_instr(text, F.lit(p)), F.lit(0)).alias("at"), F.lit(n).alias("name")) for n, p in STAGES])
    return F.transform(F.array_sort(F.filter(found, lambda s: s["at"] > 0)), lambda s: s["name"])


def event(label: Column) -> Column:
    """The event that a label of a schedule names, by the first rule that fits."""
    return tx.first_match(label, EVENTS, None)


def hedged(text: Column) -> Column:
    """Whether a text calls its dates tentative."""
    return text.rlike(f"(?i){HEDGES}")


def pay(text: Column) -> Column:
    """(level, low, high) of a pay clause; a scale that no post has is none."""
    num = lambda p, i: F.regexp_replace(F.regexp_extract(text, p, i), ",", "").try_cast("long")
    scale = r"(?i)(rs\.?|inr|₹)?\s*([0-9][0-9,]{3,7})\s*(/-)?\s*(to|-|–)\s*(rs\.?|inr|₹)?\s*([0-9][0-9,]{3,7})"
    low, high = num(scale, 2), num(scale, 6)
    sane = low.between(5000, 500000) & (high > low) & (high <= 500000)
    return F.struct(num(r"(?i)(pay\s+)?level\s*-?\s*([0-9]{1,2})\b", 2).alias("level"), F.when(sane, low).alias("low"), F.when(sane, high).alias("high"))


def advert(text: Column) -> Column:
    """The number of an advertisement."""
    found = F.regexp_extract(F.substring(text, 1, 6000), r"(?i)\b(advt\.?|advertisement|notification|vacancy\s+notice|employment\s+notice)\s*(no\.?|number|#)\s*[:.\-]?\s*([A-Z0-9][A-Z0-9/().\-]{0,30}[A-Z0-9)])", 3)
    return F.when(found != "", F.btrim(found, F.lit(".-")))


def links(text: Column) -> Column:
    """Addresses in a text, each once, without the mark that ends a sentence."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)\b(?:https?://|www\.)[^\s<>\"'()\[\]]+"), F.lit(0))
    tidy = F.transform(found, lambda u: F.regexp_replace(F.regexp_replace(u, r"[.,;:)\]}'\"/]+$", ""), r"(?i)^www\.", "https://www."))
    return F.array_distinct(F.filter(tidy, lambda u: ~F.contains(u, F.lit("@")) & (F.length(u) >= 12)))


def advert_reference(published: Column, days_found: Column, today: Column) -> Column:
    """The day that a notice speaks from: when it was published, else the latest day in it that is not to come."""
    return F.coalesce(published, F.array_max(F.filter(days_found, lambda d: d <= today)))

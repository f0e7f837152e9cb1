"""Date columns. A day is never guessed: what is not a valid day is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months, and words of file names that are about an event.
EVENT_NAMES = ("exam", "held", "date", "series", "key", "test")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH_WORD = r"(?i)(^|[^A-Za-z])(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sep(tember)?|oct(ober)?|nov(ember)?|dec(ember)?)([^A-Za-z]|$)"
_NAMES = "january february march april may june july august september october november december".split()
_MONTH = f"(?:{'|'.join(n[:3] + (f'(?:{n[3:]})?' if n[3:] else '') for n in _NAMES)}|sept)"
_YEAR = r"20[0-9]{2}(?![0-9])"
#: A day as it is written: four shapes, of which the parts tell which one it is.
_WRITTEN = "|".join((
    rf"(?<![0-9])20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}(?![0-9])",
    rf"(?<![0-9])[0-9]{{1,2}}[./-][0-9]{{1,2}}[./-](?:{_YEAR}|[0-9]{{2}}(?![0-9]))",
    rf"(?<![0-9])[0-9]{{1,2}}(?:st|nd|rd|th)?[ \t\n.,-]*{_MONTH}[ \t\n.,'-]*{_YEAR}",
    rf"(?<![a-z0-9_]){_MONTH}\.?[ \t\n]+[0-9]{{1,2}}(?:st|nd|rd|th)?,?[ \t\n]+{_YEAR}",
))


def day(year: Column, month: Column, day_: Column) -> Column:
    """A date from texts or numbers; null if there is no such day."""
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.try_to_date(F.concat_ws("-", year.cast("string"), pad(month), pad(day_)), "yyyy-MM-dd")


def month_number(word: Column) -> Column:
    """1 to 12 from a month's first three letters, else 0."""
    return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(word, 1, 3)))


def year_of_two(text: Column) -> Column:
    """A year of two digits is of this century."""
    return F.when(F.length(text) == 2, F.concat(F.lit("20"), text)).otherwise(text)


def expand_year(text: Column, reference_year: int) -> Column:
    """A year of two digits, in the hundred years that begin the year before ``reference_year``."""
    y = F.try_to_number(text, F.lit("9999")).cast("int")
    guess = y + F.lit(reference_year // 100 * 100)
    return F.when(F.length(text) == 4, y).when(guess < reference_year - 1, guess + 100).otherwise(guess)


def _day_of(written: Column) -> Column:
    """The day of one match of _WRITTEN: its numbers and its month's name, in the order that their shapes give."""
    parts = F.regexp_extract_all(written, F.lit("[0-9]+|[a-z]{3,}"), F.lit(0))
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    month = lambda p: F.when(p.rlike("^[0-9]"), p).otherwise(month_number(p).cast("string"))
    year_first, name_first = first.rlike("^[0-9]{4}$"), first.rlike("^[a-z]")
    return F.when(year_first, day(first, second, third)).when(name_first, day(third, month(first), second)).otherwise(day(year_of_two(third), month(second), first))


def parse_day_first(text: Column) -> Column:
    """The first valid day that a text names, day first where it is ambiguous."""
    written = F.regexp_extract_all(F.lower(text), F.lit(_WRITTEN), F.lit(0))
    return F.get(F.filter(F.transform(written, _day_of), lambda d: d.isNotNull()), F.lit(0))


def stamped(title: Column, file_name: Column, today: Column) -> Column:
    """(day, from) where a notice names its own day of issue, from 2000 up to ``today``: in front of its title or behind "dated",
    else in a file name that is not about an event."""
    past = lambda d: F.when((d >= F.make_date(F.lit(2000), F.lit(1), F.lit(1))) & (d <= today), d)
    front = F.split(F.ltrim(title), r"\s*[-–:|]\s", 2)
    in_front = F.when((F.size(front) > 1) & (F.length(F.get(front, F.lit(0))) <= 20), parse_day_first(F.get(front, F.lit(0))))
    behind = F.get(F.split(F.lower(title), r"\bdated\b|\bdt\b", 2), F.lit(1))
    by_title = past(F.coalesce(in_front, parse_day_first(F.substring(behind, 1, 24))))
    about_event = F.exists(F.array(*[F.lit(w) for w in EVENT_NAMES]), lambda w: F.contains(F.lower(file_name), w)) | file_name.rlike("(?i)_[a-d]_")
    by_name = past(F.when(~about_event & file_name.rlike("20[0-9]{2}"), parse_day_first(F.translate(file_name, "_", "-"))))
    return F.struct(F.coalesce(by_title, by_name).alias("day"), F.when(by_title.isNotNull(), "title").when(by_name.isNotNull(), "url").alias("from"))


def cycle_label(title: Column) -> Column:
    """The yearly cycle a title names (2026, or 2026-dec with a month), the latest year of it; years of full dates
    count only where no other year is named."""
    full = r"(?i)[0-9]{1,2}\s*[./-]\s*[0-9]{1,2}\s*[./-]\s*20[0-9]{2}|[0-9]{1,2}(st|nd|rd|th)?\s+[A-Za-z]{3,9}\.?,?\s+20[0-9]{2}|[A-Za-z]{3,9}\.?\s+[0-9]{1,2}(st|nd|rd|th)?,?\s+20[0-9]{2}"
    bare = F.regexp_replace(title, full, " ")

    def years(text: Column) -> Column:
        spans = F.regexp_extract_all(text, F.lit(r"(?<![0-9])(20[0-9]{2})\s*[-–/]\s*(?:20)?[0-9]{2}(?![0-9])"), F.lit(1))
        single = F.regexp_extract_all(text, F.lit(r"(?<![0-9])(20[0-9]{2})(?![0-9])"), F.lit(1))
        return F.when(F.size(spans) > 0, spans).otherwise(single)

    in_bare, in_title = years(bare), years(title)
    used = F.when(F.size(in_bare) > 0, bare).otherwise(title)
    year = F.coalesce(F.array_max(in_bare), F.array_max(in_title))
    month = F.lower(F.substring(F.regexp_extract(used, _MONTH_WORD, 2), 1, 3))
    return F.when(year.isNotNull(), F.when(month != "", F.concat(year, F.lit("-"), month)).otherwise(year))


def cycle_key(label: Column) -> Column:
    """(year, month) of a cycle's label, month 0 for none, (0, 0) for no label."""
    y, m = (F.regexp_extract(F.coalesce(label, F.lit("")), r"(20[0-9]{2})(-([a-z]{3}))?", i) for i in (1, 3))
    return F.struct(F.coalesce(F.when(y != "", y.cast("int")), F.lit(0)).alias("year"), F.coalesce(month_number(m), F.lit(0)).cast("int").alias("month"))


def hours_between(a: Column, b: Column) -> Column:
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 3.6e9


def wait_days(failures: Column, first: int = 7, most: int = 90) -> Column:
    """Days to wait after so many failures: twice as long each time, up to ``most``."""
    return F.least(F.lit(most).cast("double"), first * F.pow(F.lit(2.0), F.greatest(failures, F.lit(1)) - 1)).cast("int")


def countdown(day_: Column, today: Column) -> Column:
    """How far off a day is, in words that a reader needs."""
    d = F.datediff(day_, today)
    return F.when(d < 0, "past").when(d == 0, "today").when(d == 1, "tomorrow").when(d <= 7, "this week").when(d <= 30, "this month").when(d.isNotNull(), "later")


def urgent(day_: Column, today: Column, days: int = 7) -> Column:
    return F.datediff(day_, today).between(0, days)

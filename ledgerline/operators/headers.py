"""Heads of table columns that look like classes which the vocabulary does not have yet, as columns over arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables

MOST = 14  # characters of a head that may be a class
COUNT = r"^\s*[0-9][0-9,]*\s*([*]+|[(][^)]*[)])?\s*$"
# What heads of totals, notes and names have; the text layer of a document may break words, so spaces go first.
NO_CLASS = r"(?i)total|vacanc|posts?|seats?|remark|grand"
NO_CLASS_WORDS = r"(?i)\b(posts?|name|sl|sr|no|code|serial)\b"
SHAPE = r"^[A-Za-z][A-Za-z0-9.()/& -]*$"
KNOWN = "(?i)" + "|".join(tables.CLASSES.values())


def unmapped(header: Column, rows: Column) -> Column:
    """The heads (array) over columns of counts (rows: array of arrays) that are short, look like a class and name none that
    is known."""

    def strange(head: Column, i: Column) -> Column:
        cells = F.filter(F.transform(rows, lambda r: F.get(r, i)), lambda c: c.isNotNull())
        counts = F.size(F.filter(cells, lambda c: c.rlike(COUNT)))
        plain = ~F.regexp_replace(head, " ", "").rlike(NO_CLASS) & ~head.rlike(NO_CLASS_WORDS) & ~head.rlike(KNOWN)
        return head.rlike(SHAPE) & (F.length(head) <= MOST) & plain & (F.size(cells) > 0) & (2 * counts >= F.size(cells))

    return F.filter(F.transform(header, lambda h: F.trim(h)), strange)


def worklist(df: DataFrame, table: str, header: str, rows: str) -> DataFrame:
    """(head, tables, first): each head that no class is known for, in how many tables it stands, and in which first."""
    heads = df.select(table, F.explode(unmapped(F.col(header), F.col(rows))).alias("head"))
    return heads.groupBy("head").agg(F.count_distinct(table).alias("tables"), F.min(table).alias("first"))

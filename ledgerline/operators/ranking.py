"""Ranking notices for a record, and work that is done in order of how long it has waited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a kind of notice adds to its rank, and what its age in days does.
KIND_WEIGHTS = {
    "notification": 3.0, "walk_in": 2.0, "corrigendum": 1.5, "schedule": 1.5, "press_release": 1.0, "calendar": 0.8, "syllabus": 0.8, "other": 0.6,
    "admit_card": 0.5, "counselling": 0.5, "result": 0.5, "answer_key": 0.3, "application_status": 0.3,
}
OTHER_KIND = 0.5
AGES = ((200, 2.0), (400, 1.0), (801, 0.0))
OLD = -1.0
SHARE_WEIGHT, YEAR_BONUS = 10.0, 1.5


def years_of(text: Column) -> Column:
    """The years that a text names, standing alone."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit("(?<![0-9])(20[1-3][0-9])(?![0-9])"), F.lit(1)), lambda y: y.cast("int")))


def other_cycle(record: Column, notice: Column) -> Column:
    """Whether a notice names years and none of them, nor the year after one of them, is one of the record's: what is advertised in
    one year is often held the next."""
    reach = F.concat(record, F.transform(record, lambda y: y - 1))
    return (F.size(record) > 0) & (F.size(notice) > 0) & ~F.arrays_overlap(reach, notice)


def notice_score(share: Column, kind: Column, published: Column, today: Column, record_years: Column, title_years: Column) -> Column:
    """The rank of a notice: how much of the record's words it has, its kind, its age, and whether it names the record's year."""
    by_kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in KIND_WEIGHTS.items() for x in pair]), kind), F.lit(OTHER_KIND))
    age = F.datediff(today, published)
    by_age = F.when(age.isNull(), 0.0)
    for days, weight in AGES:
        by_age = by_age.when(age < days, weight)
    by_year = F.when(F.arrays_overlap(record_years, title_years), YEAR_BONUS).otherwise(0.0)
    return F.round(SHARE_WEIGHT * share + by_kind + by_age.otherwise(OLD) + by_year, 2)


def ranked(pairs: DataFrame, record: str, notice: str, *, today: Column, least: float = 0.45, top: int = 6) -> DataFrame:
    """(record, notice, score, place) of pairs (record, notice, share, kind, published, record_years, title_years): the
    notices likeliest to be about a record, best first. The limit on row_number alone lets every task keep ``top`` rows a record
    before the shuffle, so a record that everything is about is no hot key."""
    near = pairs.filter((F.col("share") >= least) & ~other_cycle(F.col("record_years"), F.col("title_years")))
    score = notice_score(F.col("share"), F.col("kind"), F.col("published"), today, F.col("record_years"), F.col("title_years"))
    order = Window.partitionBy(record).orderBy(F.desc("score"), notice)
    return near.select(record, notice, score.alias("score")).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def longest_waiting(work: DataFrame, cursors: DataFrame, key: str, cost: Column, budget: float) -> DataFrame:
    """(key, last, spent): the work of a run: what was never done first, then what waits longest, as far as the budget goes; the
    row that reaches the budget is the last one. cursors: (key, last). Rows are few (one for each site or document that is due); the
    running sum is over all of them."""
    x = work.join(cursors.select(key, "last"), key, "left").withColumn("__cost", cost)
    before = F.sum("__cost").over(Window.orderBy(F.col("last").asc_nulls_first(), key).rowsBetween(Window.unboundedPreceding, -1))
    spent = F.coalesce(before, F.lit(0.0))
    return x.withColumn("spent", spent).filter(F.col("spent") <= budget).select(key, "last", "spent")


def moved_cursors(cursors: DataFrame, done: DataFrame, key: str, today: Column) -> DataFrame:
    """The cursors after a run: what was done today, and all others as they were."""
    return cursors.join(done.select(key), key, "left_anti").select(key, "last").unionByName(done.select(key, today.alias("last")))

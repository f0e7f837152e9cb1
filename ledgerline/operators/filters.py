"""Which rows are worth keeping: stale, weak, waiting, wrong, implausible."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import wait_days


def choose(df: DataFrame, **allowed: tuple | list | None) -> DataFrame:
    """Rows whose columns are among what is allowed; nothing given allows all."""
    tests = [F.col(c).isin(*v) for c, v in allowed.items() if v]
    return df.filter(reduce(and_, tests)) if tests else df


def drop_stale(df: DataFrame, by: str, day: str, today: Column, dated: Column, beside: int = 730, ever: int = 3650) -> DataFrame:
    """Without dated rows older than ``beside`` days before their group's newest, or ``ever`` days before today.
    The newest day of a group is an aggregate, joined back: a large group is not gathered."""
    newest = df.filter(dated).groupBy(F.col(by).alias("__by")).agg(F.max(day).alias("__newest"))
    x = df.join(newest, df[by].eqNullSafe(newest["__by"]), "left")
    cut = F.greatest(F.date_sub(F.coalesce("__newest", today), beside), F.date_sub(today, ever))
    return x.filter(~dated | (F.col(day) >= cut)).drop("__by", "__newest")


def drop_weak(df: DataFrame, clause: list[str], field: str, value: str, hint: str, weak: str = "exam_date", strong: float = 0.8) -> DataFrame:
    """Without claims of the ``weak`` field where a better label of the same clause claims the value (F8)."""
    keys = [*clause, value]
    best = df.filter((F.col(field) != weak) & (F.col(hint) >= strong)).groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(hint).alias("__best"))
    x = df.join(best, reduce(and_, [df[k].eqNullSafe(best[f"__{k}"]) for k in keys]), "left")
    return x.filter((F.col(field) != weak) | (F.col(hint) >= F.coalesce("__best", F.lit(0.0)))).drop("__best", *[f"__{k}" for k in keys])


def ignore(df: DataFrame, id_: str, name: str, ids: list[str], patterns: list[str]) -> DataFrame:
    """Without listed ids and names that match a pattern."""
    bad = [F.col(id_).isin(*ids)] if ids else []
    bad += [F.col(name).rlike(p) for p in patterns]
    return df.filter(~reduce(or_, bad)) if bad else df


def eligible(frequency: Column, name: Column, recurring: tuple[str, ...] = ("annual", "biannual", "quarterly", "monthly")) -> Column:
    return frequency.isin(*recurring) & ~F.contains(name, F.lit("umbrella"))


def live(documents: Column, dates: list[Column], today: Column, days: int = 120) -> Column:
    """Whether an entity's cycle has documents and its last date is not long past."""
    last = F.greatest(*dates) if len(dates) > 1 else dates[0]
    return F.coalesce((documents > 0) & (F.datediff(today, last) <= days), F.lit(False))


def to_archive(urls: DataFrame, done: DataFrame, today: Column) -> DataFrame:
    """(url, place): addresses without a snapshot whose wait after failures is over, each once, in order."""
    first = urls.groupBy("url").agg(F.min("place").alias("place"))
    d = done.select("url", "snapshot", "tried", "failures")
    x = first.join(d, "url", "left")
    waiting = F.col("tried").isNotNull() & (F.date_add(F.to_date("tried"), wait_days(F.coalesce("failures", F.lit(1)))) > today)
    return x.filter(F.col("snapshot").isNull() & ~waiting).select("url", "place")


def attachable(notices: DataFrame, records: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """(record, notice): documents of a listed kind that name the year of the one record of their exam and cycle."""
    single = records.groupBy("exam", "year").agg(F.count("*").alias("n"), F.min("record").alias("record")).filter("n = 1")
    n = notices.filter(F.col("gone_since").isNull() & F.col("doc_type").isin(*kinds) & F.col("url").rlike(r"(?i)\.pdf($|\?)"))
    years = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", "title", "url"), F.lit(r"(?<![0-9])(20[0-9]{2})(?![0-9])"), F.lit(1)))
    named = n.select("exam", F.col("id").alias("notice"), F.explode(F.transform(years, lambda y: y.cast("int"))).alias("year"))
    return named.join(single, ["exam", "year"]).select("record", "notice")


def wrong_aliases(aliases: Column, own: Column, kinds: dict[str, str]) -> Column:
    """Aliases that name another kind of thing than the one kind that the entity is."""
    named = lambda text: F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(k)) for k, p in kinds.items()]))
    mine = named(own)
    return F.when(F.size(mine) == 1, F.filter(aliases, lambda a: (F.size(named(a)) > 0) & (F.size(F.array_intersect(named(a), mine)) == 0))).otherwise(F.array().cast("array<string>"))


def of_bodies(df: DataFrame, bodies: list[str], single: tuple[str, ...], many: str) -> DataFrame:
    """Rows that one of the bodies conducts, owns or allocates."""
    holders = F.array_distinct(F.concat(F.array_compact(F.array(*single)), F.coalesce(many, F.array().cast("array<string>"))))
    return df.filter(F.arrays_overlap(holders, F.array(*[F.lit(b) for b in bodies])))


def plausible(value_year: Column, cycle: Column, *, slack: int = 1, target: Column, sentinel: tuple[str, ...] = ("unknown", "not_announced")) -> Column:
    """Whether a found date may fill a field: its year is about the cycle's and nothing is written there yet."""
    return (F.abs(value_year - cycle) <= slack) & (target.isNull() | target.isin(*sentinel))


def uninformative(title: Column, pattern: str, entity: Column) -> Column:
    """Pages that say nothing and belong to nothing."""
    return title.rlike(pattern) & (entity.isNull() | (entity == "unknown"))


def known_facts(facts: DataFrame, record: str, value: str, blanks: tuple[str, ...] = ("", "unknown", "not_announced", "none")) -> DataFrame:
    """(record, known): how many facts a record states."""
    return facts.groupBy(record).agg(F.count_if(F.col(value).isNotNull() & ~F.col(value).isin(*blanks)).alias("known"))


def summary(df: DataFrame, by: str, fee: str, low: str, high: str, order: Column) -> DataFrame:
    """(by, fee_min, fee_max, age_min, age_max): the extremes of the fees and the first stated limits."""
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))["v"]
    return df.groupBy(by).agg(F.min(fee).alias("fee_min"), F.max(fee).alias("fee_max"), first(low).alias("age_min"), first(high).alias("age_max"))

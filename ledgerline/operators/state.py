"""State that outlives a run: what is known, when it was first seen, what has gone, how sources do.

Every function takes tables and the time of the run, and returns the new table; nothing holds the time of a run that
changed nothing, so equal inputs give equal outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rekeyed(state: DataFrame, new_id: Column, order: Column) -> DataFrame:
    """Stored rows under today's ids. Rows that become one keep the earliest first_seen, are live if any was, and
    take the rest from the last in ``order``."""
    w = Window.partitionBy("__new")
    rest = [c for c in state.columns if c not in ("id", "first_seen", "gone_since")]
    x = state.withColumn("__new", new_id)
    live = F.max(F.col("gone_since").isNull().cast("int")).over(w)
    x = x.withColumns({"first_seen": F.min("first_seen").over(w), "gone_since": F.when(live == 1, F.lit(None)).otherwise(F.col("gone_since"))})
    last = F.row_number().over(w.orderBy(order.desc(), F.desc("id")))
    return x.withColumn("__n", last).filter("__n = 1").select(F.col("__new").alias("id"), *rest, "first_seen", "gone_since")


def snapshot_merge(state: DataFrame, fresh: DataFrame, ran: DataFrame, now: Column, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """The state after a run, with the change of each row: new, back, gone or null.

    state: id, feed, ..., first_seen, gone_since; fresh: the rows of the run (id, feed, ...); ran: the feeds that ran
    well. A row seen again keeps first_seen, is no longer gone, and takes the columns ``keep`` from before where the
    run lacks them; a row not seen is gone only if its feed ran.
    """
    columns = [c for c in fresh.columns if c != "id"]
    s = state.select("id", *[F.col(c).alias(f"s_{c}") for c in state.columns if c != "id"], F.lit(True).alias("s_known"))
    f = fresh.select("id", *[F.col(c).alias(f"f_{c}") for c in columns], F.lit(True).alias("f_seen"))
    ok = ran.select(F.col("feed").alias("r_feed")).distinct().withColumn("r_ran", F.lit(True))
    both = s.join(f, "id", "full").join(ok, F.col("s_feed") == F.col("r_feed"), "left")
    seen, known = F.col("f_seen").isNotNull(), F.col("s_known").isNotNull()
    lost = ~seen & F.col("r_ran").isNotNull() & F.col("s_gone_since").isNull()
    value = lambda c: F.when(seen, F.coalesce(f"f_{c}", f"s_{c}") if c in keep else F.col(f"f_{c}")).otherwise(F.col(f"s_{c}"))
    return both.select(
        "id", *[value(c).alias(c) for c in columns],
        F.coalesce("s_first_seen", now).alias("first_seen"),
        F.when(seen, F.lit(None)).when(lost, now).otherwise(F.col("s_gone_since")).alias("gone_since"),
        F.when(seen & ~known, "new").when(seen & F.col("s_gone_since").isNotNull(), "back").when(lost, "gone").alias("change"),
    )


def change_log(merged: DataFrame, now: Column, by: str = "entity") -> DataFrame:
    """The rows that changed, in the order of the log: new, back, gone; by entity; by id."""
    rank = F.when(F.col("change") == "new", 0).when(F.col("change") == "back", 1).otherwise(2)
    named = [F.coalesce(F.col(by), F.lit("~"))] if by in merged.columns else []
    return merged.filter(F.col("change").isNotNull()).withColumn("at", now).orderBy(rank, *named, "id")


def ran_feeds(results: DataFrame) -> DataFrame:
    """Feeds that answered with rows, from the source itself and in full."""
    return results.filter(F.col("ok") & (F.coalesce("count", F.lit(0)) > 0) & F.col("via").isNull() & ~F.coalesce("partial", F.lit(False))).select("feed").distinct()


def since(df: DataFrame, key: list[str], at: str, state: list[str], tie: str) -> DataFrame:
    """Each row with the time at which the state that it shows began: states are compared with the row before."""
    w = Window.partitionBy(*key).orderBy(at, tie)
    moved = F.row_number().over(w) == 1
    for c in state:
        moved = moved | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    x = df.withColumn("__run", F.sum(moved.cast("int")).over(w))
    return x.withColumn("since", F.min(at).over(Window.partitionBy(*key, "__run"))).drop("__run")


def presence(df: DataFrame, key: list[str], day: str) -> DataFrame:
    """Stretches of days on which a key was there: (key, first, last, days)."""
    d = df.select(*key, day).distinct()
    at = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) - F.row_number().over(Window.partitionBy(*key).orderBy(day))
    return d.withColumn("__island", at).groupBy(*key, "__island").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")).drop("__island")


def health(previous: DataFrame, results: DataFrame, hours: float = 24.0) -> DataFrame:
    """The health line of each feed of a run, with alert and raised (whether the run raised it).

    previous: id, ok, status, count, since, alert; results: id, ok, status, count, not_modified, checked. An answer
    "not modified" keeps the line. ``since`` moves when ok, status or having rows does. Alerts: rows have dropped to
    none (until they return), or failing for ``hours``."""
    p = previous.select("id", *[F.col(c).alias(f"p_{c}") for c in previous.columns if c != "id"], F.lit(True).alias("p_known"))
    x = results.join(p, "id", "left")
    known = F.col("p_known").isNotNull()
    some = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    same = known & F.col("ok").eqNullSafe(F.col("p_ok")) & F.col("status").eqNullSafe(F.col("p_status")) & (some("count") == some("p_count"))
    since_ = F.when(same, F.coalesce("p_since", "checked")).otherwise(F.col("checked"))
    empty = F.col("ok") & ~some("count")
    zero, dead = "yield dropped to zero", "failing for a day"
    x = x.withColumn("n_since", since_)
    failing = ~F.col("ok") & ((F.unix_micros("checked") - F.unix_micros("n_since")) >= hours * 3.6e9)
    dropped = empty & known & some("p_count")
    alert = F.when(dropped | (empty & (F.col("p_alert") == zero)), zero).when(failing, dead)
    x = x.withColumn("n_alert", alert).withColumn("n_raised", dropped | (failing & ~F.coalesce(F.col("p_alert") == dead, F.lit(False))))
    hold = F.coalesce(F.col("not_modified"), F.lit(False)) & known
    keep = lambda c, new: F.when(hold, F.col(f"p_{c}")).otherwise(new).alias(c)
    return x.select("id", keep("ok", F.col("ok")), keep("status", F.col("status")), keep("count", F.col("count")), keep("since", F.col("n_since")), keep("alert", F.col("n_alert")), F.when(hold, False).otherwise(F.coalesce("n_raised", F.lit(False))).alias("raised"))


def tiers(rows: DataFrame, feeds: DataFrame, today: Column, hot: int = 21, warm: int = 120) -> DataFrame:
    """(feed, tier): how lately a feed had something new. rows: feed, first_seen, published; feeds: feed, pinned. What
    a feed's first day brought is its backlog and says nothing; days to come do not count; a pinned tier stands."""
    boot = rows.groupBy("feed").agg(F.to_date(F.min("first_seen")).alias("boot"))
    seen = F.to_date("first_seen")
    days = F.array_compact(F.array(F.col("published"), F.when(seen > F.col("boot"), seen)))
    active = rows.join(boot, "feed").select("feed", F.explode(days).alias("day")).filter(F.col("day") <= today).groupBy("feed").agg(F.max("day").alias("latest"))
    age = F.datediff(today, F.col("latest"))
    tier = F.when(F.col("pinned").isNotNull(), F.col("pinned")).when(age <= hot, "hot").when(age <= warm, "warm").otherwise("cold")
    return feeds.join(active, "feed", "left").select("feed", "latest", tier.alias("tier"))


def fingerprint(df: DataFrame, key: list[str], id_: str) -> DataFrame:
    """(key, fingerprint) of the set of ids: the sum of the ids' hashes modulo 2 ** 64 would need no order, but the
    text form (sha256 of the sorted ids, 16 digits) is what is stored."""
    return df.groupBy(*key).agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(id_).cast("string"))), "\n"), 256), 1, 16).alias("fingerprint"))


def due_again(index: DataFrame, now: Column, schema: int, attempts: int = 3, hours: int = 20) -> DataFrame:
    """What to do with rows done before: redo (an older schema), retry (failed, not too often, not too lately), done."""
    late = (F.unix_micros(now) - F.unix_micros("tried")) > hours * 3_600_000_000
    act = F.when((F.col("status") == "ok") & (F.coalesce("schema", F.lit(0)) < schema), "redo").when((F.col("status") == "failed") & (F.col("attempts") < attempts) & late, "retry").when(F.col("status").isin("needs_ocr", "legacy_font"), "retry").otherwise("done")
    return index.withColumn("action", act)


def keep_first_seen(found: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """Found rows (id, ...), with the time at which they were first found."""
    return found.join(stored.select("id", F.col("first_seen").alias("__f")), "id", "left").withColumn("first_seen", F.coalesce("__f", now)).drop("__f")


def moved_only(fresh: DataFrame, stored: DataFrame, columns: list[str], now: Column) -> DataFrame:
    """Fresh rows, with ``checked`` from before where nothing in ``columns`` has changed."""
    s = stored.select("id", *[F.col(c).alias(f"__{c}") for c in columns], F.col("checked").alias("__checked"))
    same = F.col("__checked").isNotNull()
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return fresh.join(s, "id", "left").withColumn("checked", F.when(same, F.col("__checked")).otherwise(now)).drop("__checked", *[f"__{c}" for c in columns])

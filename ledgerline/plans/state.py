"""State over runs, with events as observations: a feed is an event type, an id a user, a run a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state
from ..registry import register, table

OLD, NEW = "2024-01-10", "2024-01-11"


def _day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.to_date("ts") == F.lit(day).cast("date"))
    return e.groupBy(F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("id"), F.col("event_type").alias("feed")).agg(F.max("value").alias("value"))


_MERGED = f"""
o AS (SELECT event_type || '/' || user_id AS id, event_type AS feed, max(value) AS value FROM events WHERE CAST(ts AS DATE) = DATE '{OLD}' GROUP BY 1, 2),
f AS (SELECT id, feed, CASE WHEN value > 50 THEN value END AS value FROM (SELECT event_type || '/' || user_id AS id, event_type AS feed, max(value) AS value FROM events WHERE CAST(ts AS DATE) = DATE '{NEW}' GROUP BY 1, 2)),
r AS (SELECT DISTINCT feed FROM f WHERE feed <> 'error'),
"""


@register(f"""WITH {_MERGED}
s AS (SELECT *, CASE WHEN CAST(split_part(id, '/', 2) AS BIGINT) % 3 = 0 THEN DATE '2024-01-05' END AS gone FROM o),
m AS (SELECT coalesce(s.id, f.id) AS id, CASE WHEN f.id IS NOT NULL THEN f.feed ELSE s.feed END AS feed, CASE WHEN f.id IS NOT NULL THEN coalesce(f.value, s.value) ELSE s.value END AS value,
 CASE WHEN s.id IS NULL THEN DATE '{NEW}' ELSE DATE '2024-01-01' END AS first_seen, s.id IS NOT NULL AS known, f.id IS NOT NULL AS seen, s.gone, s.feed IN (SELECT feed FROM r) AS ran FROM s FULL JOIN f ON s.id = f.id)
SELECT id, feed, value, CAST(first_seen AS VARCHAR) AS first_seen, CAST(CASE WHEN seen THEN NULL WHEN gone IS NULL AND ran THEN DATE '{NEW}' ELSE gone END AS VARCHAR) AS gone_since,
 CASE WHEN seen AND NOT known THEN 'new' WHEN seen AND gone IS NOT NULL THEN 'back' WHEN NOT seen AND gone IS NULL AND ran THEN 'gone' END AS change FROM m""")
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a run: first seen, gone, back; a feed that failed changes nothing (ST1, J4, U3)."""
    m = _merge(spark, sf_dir)
    return m.withColumns({"first_seen": F.col("first_seen").cast("string"), "gone_since": F.col("gone_since").cast("string")})


def _merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda d: F.lit(d).cast("date")
    gone = F.when(F.split("id", "/").getItem(1).cast("long") % 3 == 0, at("2024-01-05"))
    old = _day(spark, sf_dir, OLD).withColumn("first_seen", at("2024-01-01")).withColumn("gone_since", gone)
    fresh = _day(spark, sf_dir, NEW).withColumn("value", F.when(F.col("value") > 50, F.col("value")))
    ran = fresh.select("feed").distinct().filter("feed <> 'error'")
    return state.snapshot_merge(old, fresh, ran, at(NEW), keep=("value",))


@register(f"""WITH {_MERGED}
s AS (SELECT *, CASE WHEN CAST(split_part(id, '/', 2) AS BIGINT) % 3 = 0 THEN 1 END AS gone FROM o),
m AS (SELECT coalesce(s.id, f.id) AS id, coalesce(f.feed, s.feed) AS feed, CASE WHEN s.id IS NULL THEN 'new' WHEN f.id IS NOT NULL AND gone = 1 THEN 'back' WHEN f.id IS NULL AND gone IS NULL AND s.feed IN (SELECT feed FROM r) THEN 'gone' END AS change FROM s FULL JOIN f ON s.id = f.id)
SELECT '2024-01' AS month, feed, change, count(*) AS n, min(id) AS first_id FROM m WHERE change IS NOT NULL GROUP BY ALL""")
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of a run, by month and feed (K2)."""
    log = state.change_log(_merge(spark, sf_dir), F.lit(NEW).cast("date"), "feed")
    return log.groupBy(F.date_format("at", "yyyy-MM").alias("month"), "feed", "change").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@register("""WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), i AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS g FROM d)
SELECT user_id, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS days FROM i GROUP BY user_id, g""")
def presence_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of days on which each user was there."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return state.presence(e, ["user_id"], "day").withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@register("""WITH l AS (SELECT *, event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 AS moved FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(CAST(moved AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM l)
SELECT event_id, CAST(epoch_us(min(ts) OVER (PARTITION BY user_id, run)) AS BIGINT) AS since FROM r""")
def state_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Since when each user has been in the state that an event shows."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return state.since(e, ["user_id"], "ts", ["event_type"], "event_id").select("event_id", F.unix_micros(F.col("since").cast("timestamp")).alias("since"))


@register("""WITH e AS (SELECT user_id AS feed, CAST(ts AS DATE) AS d, CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END AS published FROM events),
b AS (SELECT feed, min(d) AS boot FROM e GROUP BY feed), a AS (SELECT e.feed, max(greatest(CASE WHEN published <= DATE '2024-01-25' THEN published END, CASE WHEN d > boot AND d <= DATE '2024-01-25' THEN d END)) AS latest FROM e JOIN b USING (feed) GROUP BY e.feed)
SELECT f.feed, CAST(latest AS VARCHAR) AS latest, CASE WHEN f.feed % 50 = 0 THEN 'hot' WHEN DATE '2024-01-25' - latest <= 2 THEN 'hot' WHEN DATE '2024-01-25' - latest <= 9 THEN 'warm' ELSE 'cold' END AS tier
FROM (SELECT DISTINCT user_id AS feed FROM events) f LEFT JOIN a USING (feed)""")
def activity_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How lively each feed is; its first day is backlog, days to come do not count (ST4, A4)."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("feed"), F.to_date("ts").alias("first_seen"), F.when(F.col("event_type") == "purchase", F.to_date("ts")).alias("published"))
    feeds = rows.select("feed").distinct().withColumn("pinned", F.when(F.col("feed") % 50 == 0, "hot"))
    return state.tiers(rows, feeds, F.lit("2024-01-25").cast("date"), hot=2, warm=9).withColumn("latest", F.col("latest").cast("string"))


def _health_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events")
    day = lambda d: e.filter(F.to_date("ts") == F.lit(d).cast("date")).groupBy(F.col("user_id").alias("id")).agg(F.count_if(F.col("event_type") != "error").alias("count"), F.max((F.col("event_type") == "error").cast("int")).alias("bad"), F.min("ts").cast("timestamp").alias("at"))
    p = day(OLD).select("id", (F.col("bad") == 0).alias("ok"), F.when(F.col("bad") == 0, 200).otherwise(500).alias("status"), "count", F.col("at").alias("since"), F.when(F.col("id") % 10 == 0, "yield dropped to zero").alias("alert"))
    r = day("2024-01-12").select("id", (F.col("bad") == 0).alias("ok"), F.when(F.col("bad") == 0, 200).otherwise(500).alias("status"), F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("count")).alias("count"), (F.col("id") % 14 == 0).alias("not_modified"), F.col("at").alias("checked"))
    return p, r


_HEALTH_DAY = """SELECT user_id AS id, count(*) FILTER (WHERE event_type <> 'error') AS n, max(CAST(event_type = 'error' AS INTEGER)) AS bad, min(ts) AS at_ FROM events WHERE CAST(ts AS DATE) = DATE '{}' GROUP BY 1"""


@register(f"""WITH p AS (SELECT id, bad = 0 AS ok, CASE WHEN bad = 0 THEN 200 ELSE 500 END AS status, n, at_ AS since, CASE WHEN id % 10 = 0 THEN 'yield dropped to zero' END AS alert FROM ({_HEALTH_DAY.format(OLD)})),
r AS (SELECT id, bad = 0 AS ok, CASE WHEN bad = 0 THEN 200 ELSE 500 END AS status, CASE WHEN id % 6 = 0 THEN 0 ELSE n END AS n, id % 14 = 0 AS nm, at_ AS checked FROM ({_HEALTH_DAY.format("2024-01-12")})),
x AS (SELECT r.*, p.id IS NOT NULL AS known, p.ok AS p_ok, p.status AS p_status, p.n AS p_n, p.since AS p_since, p.alert AS p_alert,
 CASE WHEN p.id IS NOT NULL AND r.ok = p.ok AND r.status = p.status AND (r.n > 0) = (p.n > 0) THEN p.since ELSE checked END AS since FROM r LEFT JOIN p USING (id)),
a AS (SELECT *, CASE WHEN ok AND n = 0 AND known AND (p_n > 0 OR p_alert = 'yield dropped to zero') THEN 'yield dropped to zero' WHEN NOT ok AND checked - since >= INTERVAL 24 HOUR THEN 'failing for a day' END AS alert,
 (ok AND n = 0 AND known AND p_n > 0) OR (NOT ok AND checked - since >= INTERVAL 24 HOUR AND coalesce(p_alert, '') <> 'failing for a day') AS raised FROM x)
SELECT id, CASE WHEN nm AND known THEN p_ok ELSE ok END AS ok, CASE WHEN nm AND known THEN p_status ELSE status END AS status, CASE WHEN nm AND known THEN p_n ELSE n END AS count,
 CAST(epoch_us(CASE WHEN nm AND known THEN p_since ELSE since END) AS BIGINT) AS since, CASE WHEN nm AND known THEN p_alert ELSE alert END AS alert, CASE WHEN nm AND known THEN false ELSE raised END AS raised FROM a""")
def health_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health of feeds after a run, with the alerts that it raises (ST3)."""
    return state.health(*_health_tables(spark, sf_dir)).withColumn("since", F.unix_micros("since"))


@register("SELECT event_type, substr(sha256(string_agg(u, chr(10) ORDER BY u)), 1, 16) AS fingerprint FROM (SELECT DISTINCT event_type, CAST(user_id AS VARCHAR) AS u FROM events) GROUP BY event_type")
def set_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each feed's set of ids (ST5)."""
    return state.fingerprint(table(spark, sf_dir, "events"), ["event_type"], "user_id")


@register("""WITH k AS (SELECT user_id % 40 AS id, event_id, ts, CASE WHEN event_type IN ('view', 'click') THEN ts END AS gone FROM events),
m AS (SELECT id, min(ts) AS first_seen, bool_or(gone IS NULL) AS live, max(struct_pack(ts := ts, e := event_id, g := gone)) AS last FROM k GROUP BY id)
SELECT id, last.e AS event_id, CAST(epoch_us(first_seen) AS BIGINT) AS first_seen, CAST(CASE WHEN live THEN NULL ELSE epoch_us(last.g) END AS BIGINT) AS gone_since FROM m""")
def rekeyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows under coarser ids."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_id", "user_id", F.col("ts").cast("timestamp").alias("first_seen"), F.when(F.col("event_type").isin("view", "click"), F.col("ts").cast("timestamp")).alias("gone_since"), F.col("ts").alias("at"))
    out = state.rekeyed(e, F.col("user_id") % 40, F.col("at"))
    return out.select("id", "event_id", F.unix_micros("first_seen").alias("first_seen"), F.unix_micros("gone_since").alias("gone_since"))


@register("""SELECT event_id, CASE WHEN event_type = 'view' AND event_id % 4 < 3 THEN 'redo' WHEN event_type = 'error' AND event_id % 5 < 3 AND TIMESTAMP '2024-01-20 00:00:00' - ts > INTERVAL 20 HOUR THEN 'retry' ELSE 'done' END AS action FROM events""")
def retry_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do again: older schemas, failures that may be retried (ST6)."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "view", "ok").when(F.col("event_type") == "error", "failed").otherwise("not_pdf").alias("status"), (F.col("event_id") % 4).alias("schema"), (F.col("event_id") % 5).alias("attempts"), F.col("ts").cast("timestamp").alias("tried"))
    return state.due_again(e, F.lit("2024-01-20 00:00:00").cast("timestamp"), 3).select("event_id", "action")


@register("""WITH f AS (SELECT DISTINCT user_id AS id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'), s AS (SELECT user_id AS id, min(ts) AS first_seen FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-12' AND event_type = 'signup' GROUP BY 1)
SELECT f.id, CAST(epoch_us(coalesce(s.first_seen, TIMESTAMP '2024-01-12 00:00:00')) AS BIGINT) AS first_seen FROM f LEFT JOIN s USING (id)""")
def worklist_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A worklist that remembers when a row was first on it (K8, J29, ST9)."""
    e = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-12").cast("date")
    found = e.filter(F.to_date("ts") == cut).select(F.col("user_id").alias("id")).distinct()
    stored = e.filter((F.to_date("ts") < cut) & (F.col("event_type") == "signup")).groupBy(F.col("user_id").alias("id")).agg(F.min("ts").cast("timestamp").alias("first_seen"))
    return state.keep_first_seen(found, stored, F.lit("2024-01-12 00:00:00").cast("timestamp")).withColumn("first_seen", F.unix_micros("first_seen"))

"""Filters, link states, names and facts in sentences, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters, links, naming, prose
from ..registry import register, table


@register("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority IN ('1-URGENT')")
def feed_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by what is allowed of their columns."""
    return filters.choose(table(spark, sf_dir, "orders"), o_orderstatus=("O", "P"), o_orderpriority=("1-URGENT",), o_custkey=None).select("o_orderkey")


@register("""WITH x AS (SELECT *, max(CASE WHEN l_returnflag <> 'A' THEN CAST(l_shipdate AS DATE) END) OVER (PARTITION BY l_orderkey) AS newest FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey FROM x WHERE l_returnflag = 'A' OR CAST(l_shipdate AS DATE) >= greatest(newest - 60, DATE '2002-01-01' - 2000)""")
def stale_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated facts without those that are stale beside the newest."""
    x = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return filters.drop_stale(x, "l_orderkey", "day", F.lit("2002-01-01").cast("date"), F.col("l_returnflag") != "A", beside=60, ever=2000).select("l_orderkey", "l_linenumber", "l_partkey")


@register("""WITH c AS (SELECT l_orderkey AS clause, CASE l_returnflag WHEN 'N' THEN 'exam_date' ELSE l_returnflag END AS field, l_suppkey % 3 AS value, l_discount * 10 AS hint, l_linenumber, l_partkey FROM lineitem),
b AS (SELECT clause, value, max(hint) AS best FROM c WHERE field <> 'exam_date' AND hint >= 0.8 GROUP BY 1, 2)
SELECT c.clause, c.l_linenumber, c.l_partkey FROM c LEFT JOIN b ON b.clause = c.clause AND b.value = c.value WHERE field <> 'exam_date' OR hint >= coalesce(best, 0)""")
def weak_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak claims give way to a better label on the same value (F8)."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clause"), F.when(F.col("l_returnflag") == "N", "exam_date").otherwise(F.col("l_returnflag")).alias("field"), (F.col("l_suppkey") % 3).alias("value"), (F.col("l_discount") * 10).alias("hint"), "l_linenumber", "l_partkey")
    return filters.drop_weak(c, ["clause"], "field", "value", "hint").select("clause", "l_linenumber", "l_partkey")


@register("SELECT p_partkey FROM part WHERE CAST(p_partkey AS VARCHAR) NOT IN ('1', '5', '900') AND NOT regexp_matches(p_name, '^green') AND NOT regexp_matches(p_name, 'gear$')")
def ignore_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that no ignore list names."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_partkey", "p_name")
    return filters.ignore(p, "id", "p_name", ["1", "5", "900"], ["^green", "gear$"]).select("p_partkey")


@register("""SELECT c_custkey, c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT contains(c_name, 'umbrella') AS eligible,
 coalesce(n > 0 AND date_diff('day', last_day, DATE '2001-08-01') <= 120, false) AS live FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which entities recur, and which are in season."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max(F.to_date("o_orderdate")).alias("last_day"))
    x = table(spark, sf_dir, "customer").join(o, "c_custkey", "left")
    return x.select("c_custkey", filters.eligible(F.col("c_mktsegment"), F.col("c_name"), ("BUILDING", "MACHINERY")).alias("eligible"), filters.live(F.col("n"), [F.col("last_day")], F.lit("2001-08-01").cast("date")).alias("live"))


@register("""WITH u AS (SELECT url, min(page_id) AS place FROM pages GROUP BY url), d AS (SELECT DISTINCT url, page_id % 4 = 0 AS has, page_id % 3 + 1 AS failures, page_id % 40 AS ago FROM pages WHERE url LIKE 'https%')
SELECT u.url, place FROM u LEFT JOIN d ON d.url = u.url WHERE NOT coalesce(has, false) AND NOT coalesce(DATE '2026-01-01' - CAST(ago AS INTEGER) + CAST(least(7 * power(2, failures - 1), 90) AS INTEGER) > DATE '2026-01-01', false)""")
def archive_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses to archive: no snapshot, not waiting."""
    pages = table(spark, sf_dir, "pages")
    today = F.lit("2026-01-01").cast("date")
    done = pages.filter("url LIKE 'https%'").select("url", F.when(F.col("page_id") % 4 == 0, "snap").alias("snapshot"), F.date_sub(today, (F.col("page_id") % 40).cast("int")).alias("tried"), (F.col("page_id") % 3 + 1).alias("failures"))
    return filters.to_archive(pages.select("url", F.col("page_id").alias("place")), done, today)


@register("""WITH n AS (SELECT o_orderkey AS id, o_custkey AS exam, o_orderpriority AS doc_type, 'https://x.org/' || year(o_orderdate) || '/n.pdf' AS url, o_orderstatus = 'F' AS gone, year(o_orderdate) AS y FROM orders),
r AS (SELECT c_custkey % 1000 AS exam, 2000 + c_custkey % 2 AS y, min(c_name) AS record FROM customer GROUP BY 1, 2 HAVING count(*) = 1)
SELECT record, n.id AS notice FROM n JOIN r ON r.exam = n.exam AND r.y = n.y WHERE NOT gone AND doc_type IN ('1-URGENT', '2-HIGH') AND n.y >= 2000""")
def attach_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that belong to the one record of their exam and year."""
    o = table(spark, sf_dir, "orders")
    notices = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("exam"), F.col("o_orderpriority").alias("doc_type"), F.concat(F.lit("https://x.org/"), F.year("o_orderdate").cast("string"), F.lit("/n.pdf")).alias("url"), F.lit("").alias("title"), F.when(F.col("o_orderstatus") == "F", F.lit("x")).alias("gone_since"))
    records = table(spark, sf_dir, "customer").select(F.col("c_name").alias("record"), (F.col("c_custkey") % 1000).alias("exam"), (2000 + F.col("c_custkey") % 2).cast("int").alias("year"))
    return filters.attachable(notices, records, ("1-URGENT", "2-HIGH"))


@register("""WITH x AS (SELECT p_partkey, [p_name, p_type || ' box', 'plain'] AS a, p_name || ' ' || p_type AS own FROM part)
SELECT p_partkey, array_to_string(CASE WHEN CAST(regexp_matches(own, '(?i)box') AS INTEGER) + CAST(regexp_matches(own, '(?i)gear') AS INTEGER) = 1 THEN
 list_filter(a, lambda v: (regexp_matches(v, '(?i)box') OR regexp_matches(v, '(?i)gear')) AND NOT ((regexp_matches(v, '(?i)box') AND regexp_matches(own, '(?i)box')) OR (regexp_matches(v, '(?i)gear') AND regexp_matches(own, '(?i)gear')))) ELSE [] END, '|') AS wrong FROM x""")
def wrong_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases that name another kind."""
    p = table(spark, sf_dir, "part")
    aliases = F.array("p_name", F.concat("p_type", F.lit(" box")), F.lit("plain"))
    return p.select("p_partkey", F.array_join(filters.wrong_aliases(aliases, F.concat_ws(" ", "p_name", "p_type"), {"box": "(?i)box", "gear": "(?i)gear"}), "|").alias("wrong"))


@register("SELECT o_orderkey FROM orders WHERE list_has_any([o_orderstatus, o_orderpriority] || [CAST(o_custkey % 5 AS VARCHAR)], ['F', '3'])")
def scoped_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that a body conducts, owns or allocates."""
    o = table(spark, sf_dir, "orders").withColumn("many", F.array((F.col("o_custkey") % 5).cast("string")))
    return filters.of_bodies(o, ["F", "3"], ("o_orderstatus", "o_orderpriority"), "many").select("o_orderkey")


@register("SELECT l_orderkey, min(l_extendedprice) AS fee_min, max(l_extendedprice) AS fee_max, arg_min(CAST(l_quantity AS INTEGER), row(l_linenumber, CAST(l_quantity AS INTEGER))) FILTER (WHERE l_quantity > 20) AS age_min, arg_min(CAST(l_quantity AS INTEGER), row(l_linenumber, CAST(l_quantity AS INTEGER))) FILTER (WHERE l_quantity > 30) AS age_max FROM lineitem GROUP BY 1")
def document_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extremes and the first stated limits of a document."""
    q = F.col("l_quantity").cast("int")
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.when(q > 20, q).alias("low"), F.when(q > 30, q).alias("high"))
    return filters.summary(x, "l_orderkey", "l_extendedprice", "low", "high", F.col("l_linenumber"))


_STATUS = "CASE page_id % 9 WHEN 0 THEN 404 WHEN 1 THEN 403 WHEN 2 THEN 500 ELSE 200 END"


@register(f"""WITH x AS (SELECT page_id, url, {_STATUS} AS s, CASE WHEN page_id % 5 = 0 THEN 'https://other.org/404/x' WHEN page_id % 7 = 0 THEN 'https://moved.example.org/' ELSE url END AS f FROM pages),
h AS (SELECT *, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS a, regexp_replace(lower(regexp_extract(f, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS b FROM x)
SELECT page_id, CASE WHEN s IN (401, 403, 429, 503) THEN 'blocked' WHEN s IN (404, 410) THEN 'not_found' WHEN s >= 400 THEN 'error' WHEN regexp_matches(f, '(?i)page\\s+not\\s+found|404\\s+error|/404\\b') THEN 'soft_404' WHEN a <> b THEN 'redirected' ELSE 'ok' END AS state FROM h""")
def link_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a checked address turned out to be."""
    k = F.col("page_id")
    status = F.when(k % 9 == 0, 404).when(k % 9 == 1, 403).when(k % 9 == 2, 500).otherwise(200)
    final = F.when(k % 5 == 0, "https://other.org/404/x").when(k % 7 == 0, "https://moved.example.org/").otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", links.verified(status, F.col("url"), final, F.lit("")).alias("state"))


@register("""WITH l AS (SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'https://x.org/' || page_id || '.pdf' ELSE 'https://x.org/' || page_id END AS url FROM pages),
c AS (SELECT url, CASE page_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'not_found' WHEN 2 THEN 'blocked' END AS state, CASE WHEN page_id % 8 = 0 THEN 'portal' ELSE 'page' END AS kind FROM l)
SELECT l.page_id, CASE WHEN regexp_matches(l.url, '\\.pdf$') AND coalesce(state, '') <> 'ok' THEN 'file' WHEN state = 'not_found' THEN 'broken' WHEN state = 'ok' THEN kind ELSE 'unknown' END AS kind FROM l LEFT JOIN c USING (url)""")
def link_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of a record's links by their checks."""
    k = F.col("page_id")
    url = F.concat(F.lit("https://x.org/"), k.cast("string"), F.when(k % 6 == 0, ".pdf").otherwise(""))
    mine = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    checks = mine.select("url", F.when(k % 4 == 0, "ok").when(k % 4 == 1, "not_found").when(k % 4 == 2, "blocked").alias("state"), F.when(k % 8 == 0, "portal").otherwise("page").alias("kind"))
    return links.kinds(mine, checks).select("page_id", "kind")


@register("""WITH x AS (SELECT l_orderkey, l_partkey, list_distinct(string_split(lower(p_name), ' ')) AS a, ['blue', 'box', 'small', 'gear'] AS b FROM lineitem JOIN part ON p_partkey = l_partkey),
o AS (SELECT DISTINCT l_orderkey, l_partkey, len(list_intersect(a, b)) AS overlap FROM x), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY overlap DESC, l_partkey) AS n FROM o WHERE overlap > 0)
SELECT l_orderkey, l_partkey, overlap FROM r WHERE n <= 4""")
def linked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a page that share most words with its record."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct().join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.split(F.lower("p_name"), " ").alias("a")), "l_partkey")
    x = x.withColumn("b", F.array(*[F.lit(w) for w in ("blue", "box", "small", "gear")]))
    return links.word_overlap(x, "l_orderkey", "a", "b", "l_partkey").select("l_orderkey", "l_partkey", "overlap")


@register("""SELECT id, CASE WHEN count(*) OVER (PARTITION BY bare) = 1 THEN bare ELSE id END AS stem FROM (SELECT c_nationkey % 3 || '-' || c_custkey % 1000 AS id, CAST(c_custkey % 1000 AS VARCHAR) AS bare FROM customer)""")
def unique_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids without their prefix where that stays unique."""
    ids = table(spark, sf_dir, "customer").select(F.concat_ws("-", (F.col("c_nationkey") % 3).cast("string"), (F.col("c_custkey") % 1000).cast("string")).alias("id"))
    return naming.unique_stems(ids, "id")


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as prose of notices."""
    k = F.col("o_orderkey")
    low, high = (k % 10 + 18).cast("string"), (k % 20 + 20).cast("string")
    text = F.concat(
        F.lit("Advertisement No. "), k.cast("string"), F.lit("/2026\nAge between "), low, F.lit(" and "), high, F.lit(" years\nUpper age limit is relaxable by "), (k % 7 + 1).cast("string"),
        F.lit(" years for SC/ST\nCandidates must have a "), F.when(k % 3 == 0, "diploma").when(k % 3 == 1, "bachelor's degree").otherwise("PhD or 10th"), F.lit("\nSelection: interview, then written exam\nPay Level - "), (k % 14 + 1).cast("string"), F.lit(" Rs. "), (k % 9000 + 1000).cast("string"), F.lit(" - 50000\nApply at https://x.org/"), k.cast("string"), F.lit("."),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))


@register("""SELECT o_orderkey, CAST(o_orderkey % 10 + 18 AS INTEGER) AS age_min, CAST(o_orderkey % 20 + 20 AS INTEGER) AS age_max FROM orders WHERE o_orderkey % 10 + 18 < o_orderkey % 20 + 20""")
def age_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages that clauses state; relaxations and limits upside down are none."""
    return prose.ages(prose.clause_rows(_notices(spark, sf_dir), "o_orderkey", "text")).select("o_orderkey", "age_min", "age_max")


@register("""SELECT o_orderkey, o_orderkey || '/2026' AS advert, CASE o_orderkey % 3 WHEN 0 THEN 'Diploma / ITI' WHEN 1 THEN 'Graduate' ELSE 'Doctorate,Class 10' END AS levels, 'Interview,Written examination' AS stages, CAST(o_orderkey % 14 + 1 AS BIGINT) AS pay_level,
 CASE WHEN o_orderkey % 9000 + 1000 BETWEEN 5000 AND 49999 THEN CAST(o_orderkey % 9000 + 1000 AS BIGINT) END AS pay_low, 'https://x.org/' || o_orderkey AS link, CAST(o_orderkey % 7 + 1 AS INTEGER) AS relaxed, 'SC,ST' AS who FROM orders""")
def notice_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advert number, levels, stages, pay, links and relaxations of notices."""
    n = _notices(spark, sf_dir)
    relaxed = prose.relaxations(prose.clause_rows(n, "o_orderkey", "text")).select("o_orderkey", F.col("years").alias("relaxed"), F.array_join("categories", ",").alias("who"))
    p = prose.pay(F.regexp_extract("text", r"Pay Level[^\n]*", 0))
    t = F.col("text")
    facts = n.select("o_orderkey", prose.advert(t).alias("advert"), F.array_join(prose.levels(t), ",").alias("levels"), F.array_join(prose.stages(t), ",").alias("stages"), p["level"].alias("pay_level"), p["low"].alias("pay_low"), F.get(prose.links(t), F.lit(0)).alias("link"))
    return facts.join(relaxed, "o_orderkey")


@register("""SELECT p_partkey, regexp_replace(coalesce(CASE WHEN p_partkey % 4 = 0 THEN 'CAT ' || p_brand END, CASE WHEN p_partkey % 4 = 1 THEN p_name END, 'BODY ' || p_name) || CASE WHEN p_partkey % 2 = 0 THEN ' 2026-27' ELSE '' END, '\\s+$', '') AS short_title FROM part""")
def short_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short titles: the catalogue's, an alias, what is left of the official one; with the cycle."""
    k = F.col("p_partkey")
    aliases = F.when(k % 4 == 1, F.array(F.concat("p_name", F.lit(" by a very long name that does not fit into any title")), F.col("p_name"))).otherwise(F.array().cast("array<string>"))
    official = F.concat(F.lit("Recruitment to the posts of "), "p_name", F.lit(" (several)"))
    title = naming.short_title(F.when(k % 4 == 0, F.concat(F.lit("CAT "), "p_brand")), aliases, official, F.lit("BODY"), F.when(k % 2 == 0, "2026-27"))
    return table(spark, sf_dir, "part").select("p_partkey", title.alias("short_title"))


@register("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name, 'examination' AS head FROM part UNION ALL SELECT p_partkey, 'ABCD', 'acronym' FROM part""")
def series_mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that titles name."""
    p = table(spark, sf_dir, "part")
    titles = p.select("p_partkey", F.concat(F.lit("Notification for "), F.initcap("p_name"), F.lit(" Examination 2026 and ABCD 2025")).alias("title"))
    return naming.series_names(titles, "p_partkey", "title")

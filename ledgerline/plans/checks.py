"""Scalars and small rules over the driver's rows: words, days, hosts, fetches, feeds, kinds of notices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, urls, values
from ..functions import text as tx
from ..operators import discovery, filters, links, matching, merge, prose, selection, state, vocabulary
from ..registry import register, table
from ..sources import listings


@register("""WITH w AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS t FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN false WHEN p_partkey % 3 = 1 THEN len(t) >= 2 AND t[1] <> t[2] ELSE false END AS named FROM w""")
def words_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that have all words which tell an entity apart, two at least."""
    title = F.split(F.lower("p_name"), " ")
    first, second = F.get(title, F.lit(0)), F.get(title, F.lit(1))
    wanted = F.array_distinct(F.array_compact(F.when(F.col("p_partkey") % 3 == 0, F.array(first)).when(F.col("p_partkey") % 3 == 1, F.array(first, second)).otherwise(F.array(first, F.lit("absent")))))
    return table(spark, sf_dir, "part").select("p_partkey", matching.contains_all(title, wanted).alias("named"))


@register("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unknown_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was found and is not known yet."""
    known = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return discovery.unknown_only(table(spark, sf_dir, "customer").select("c_custkey"), known, "c_custkey")


@register("""SELECT o_orderkey, '{' || CASE WHEN o_orderstatus = 'F' THEN '"status":"F",' ELSE '' END || '"key":' || o_orderkey || '}' AS json FROM orders""")
def pruned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without what is null (F16)."""
    record = F.struct(F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("status"), F.col("o_orderkey").alias("key"), F.lit(None).cast("string").alias("never"))
    return table(spark, sf_dir, "orders").select("o_orderkey", values.pruned(record).alias("json"))


@register("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 2 AND (o_orderstatus = 'O' OR o_orderstatus = 'P')")
def says_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that say nothing and belong to nothing."""
    k = F.col("o_orderkey") % 3
    title = F.when(k == 0, "Read more").when(k == 1, "Download PDF").otherwise("Result of the test")
    entity = F.when(F.col("o_orderstatus") == "P", "unknown").when(F.col("o_orderstatus") == "F", "someone")
    o = table(spark, sf_dir, "orders")
    return o.filter(filters.uninformative(title, listings.UNINFORMATIVE, entity)).select("o_orderkey")


@register("SELECT c_custkey FROM customer WHERE CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 7 = date_diff('day', DATE '1970-01-01', DATE '2001-03-04') % 7")
def rotation_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of the work whose day it is."""
    return selection.rotation(table(spark, sf_dir, "customer"), F.lit("2001-03-04").cast("date"), 7, "c_custkey").select("c_custkey")


@register("""WITH x AS (SELECT o_orderkey, [o_orderkey % 5, 5 + o_orderkey % 3] AS a, [o_orderkey % 5, 9, 5 + o_orderkey % 2] AS b FROM orders)
SELECT o_orderkey, array_to_string(list_concat(a, list_filter(b, lambda v: NOT list_contains(a, v))), ',') AS both FROM x""")
def list_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists joined in order, each item once."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(merge.ordered_union(F.array(k % 5, 5 + k % 3), F.array(k % 5, F.lit(9).cast("long"), 5 + k % 2)), ",").alias("both"))


@register("SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) AS digest FROM documents")
def collapsed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White space to one space."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.collapse(F.col("text"))).alias("digest"))


@register("""WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 = 0 THEN d ELSE CASE WHEN d + 400 <= DATE '2000-06-01' THEN d + 400 WHEN d + 30 <= DATE '2000-06-01' THEN d + 30 END END AS VARCHAR) AS day FROM x""")
def speaking_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day that a notice speaks from."""
    d = F.to_date("o_orderdate")
    day = prose.advert_reference(F.when(F.col("o_orderkey") % 4 == 0, d), F.array(F.date_add(d, 30), F.date_add(d, 400)), F.lit("2000-06-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", day.cast("string").alias("day"))


@register("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'registration_deadline' WHEN 1 THEN 'registration_open' WHEN 2 THEN 'admit_card' WHEN 3 THEN 'answer_key' WHEN 4 THEN 'result' END AS event, o_orderkey % 7 < 3 AS hedged FROM orders""")
def events_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that labels name, and whether a text hedges."""
    k = F.col("o_orderkey")
    label = F.element_at(F.array(*[F.lit(x) for x in ("Last date to apply", "Opening of online registration", "Download of hall ticket", "Final answer key", "Merit list", "Venue")]), (k % 6 + 1).cast("int"))
    text = F.concat(label, F.element_at(F.array(*[F.lit(x) for x in (" (tentative)", ": likely in May", ", subject  to change", ": 12.03.2026", " is fixed", "", " as notified")]), (k % 7 + 1).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", prose.event(label).alias("event"), prose.hedged(text).alias("hedged"))


@register("""SELECT l_orderkey, l_linenumber, CAST(sum(24 * date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-06-01')) AS DOUBLE) AS hours FROM lineitem GROUP BY ALL""")
def hours_on_the_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours between two times."""
    x = table(spark, sf_dir, "lineitem").withColumn("h", dates.hours_between(F.to_date("l_shipdate"), F.lit("2001-06-01").cast("date")))
    return x.groupBy("l_orderkey", "l_linenumber").agg(F.sum("h").alias("hours"))


@register("""SELECT c_custkey, CASE WHEN c_custkey % 150 <= 25 THEN 0.1 WHEN c_custkey % 150 <= 60 THEN 0.05 WHEN c_custkey % 150 <= 120 THEN 0.0 ELSE -0.1 END AS nearness, greatest(c_custkey % 10, c_custkey % 7) / 10.0 AS top,
abs(c_custkey % 10 - c_custkey % 7) / 10.0 AS margin, c_custkey % 3 <> 2 AS same FROM customer""")
def evidence_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of evidence: nearness, the likeliest and its lead, one value in two spellings (M3)."""
    k = F.col("c_custkey")
    p = F.array((k % 10) / 10.0, (k % 7) / 10.0)
    a = F.concat(F.lit("Rs. "), k.cast("string"), F.lit(" on 05.06.2026"))
    b = F.when(k % 3 == 0, F.concat(F.lit("rs.  "), k.cast("string"), F.lit(" ON 05.06.2026"))).when(k % 3 == 1, F.concat(F.lit("5/6/2026: "), k.cast("string"), F.lit(" rupees"))).otherwise(F.concat(F.lit("7/6/2025: "), k.cast("string")))
    return table(spark, sf_dir, "customer").select("c_custkey", values.proximity(k % 150).alias("nearness"), values.top(p).alias("top"), F.round(values.margin(p), 9).alias("margin"), values.same_value(a, b).alias("same"))


@register("""SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'failed' WHEN page_id % 5 = 1 THEN 'failed' WHEN length(html) > 2000 THEN 'too_large' WHEN page_id % 5 IN (2, 3) THEN 'fetched' ELSE 'not_pdf' END AS outcome FROM pages""")
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of fetches."""
    k = F.col("page_id") % 5
    status = F.when(k == 0, F.lit(None).cast("int")).when(k == 1, 404).otherwise(200)
    kind = F.when(k == 2, "application/pdf").when(k == 3, "Application/PDF; charset=x").when(k == 4, "text/html")
    return table(spark, sf_dir, "pages").select("page_id", links.fetched(status, kind, F.length("html"), 2000).alias("outcome"))


@register("""SELECT DISTINCT o_custkey AS feed FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0""")
def feeds_that_ran(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of which a missing row is gone: answered, with rows, in full, from the source itself (ST2, S23)."""
    k = F.col("o_orderkey")
    results = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("feed"), (F.col("o_orderstatus") != "P").alias("ok"), F.when(k % 4 == 0, 0).when(k % 4 == 1, 3).otherwise(1).alias("count"), F.when(k % 5 == 0, "archive").alias("via"), F.when(k % 7 == 0, True).alias("partial"))
    return state.ran_feeds(results)


@register("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 = 1 THEN 'now' ELSE 'before' END AS checked FROM orders""")
def times_that_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose time moves only where they have changed (ST10)."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k.alias("id"), F.col("o_custkey").alias("value"), F.when(F.col("o_orderstatus") == "F", "x").alias("note"))
    stored = o.filter(F.col("id") % 3 != 0).withColumns({"value": F.when(F.col("id") % 2 == 1, F.col("value") + 1).otherwise(F.col("value")), "checked": F.lit("before")})
    return state.moved_only(o, stored, ["value", "note"], F.lit("now")).select("id", "checked")


@register("""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS h FROM pages) SELECT page_id, page_id % 3 <> 2 AS same FROM h""")
def sites_of_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts that are a site or below it."""
    host = urls.host(F.col("url"))
    k = F.col("page_id") % 3
    other = F.when(k == 0, host).when(k == 1, F.concat(F.lit("jobs."), host)).otherwise(F.concat(F.lit("not"), host))
    return table(spark, sf_dir, "pages").select("page_id", urls.same_site(other, host).alias("same"))


_TITLES = (("Walk-in on Monday", "walk_in"), ("List of eligible candidates", "application_status"), ("Seat allotment, round 2", "counselling"), ("Corrigendum to the notice", "corrigendum"), ("Final answer key", "answer_key"), ("Hall ticket for the test", "admit_card"), ("Merit list of clerks", "result"), ("Annual calendar", "calendar"), ("Interview schedule", "schedule"), ("Press note", "press_release"), ("Syllabus", "syllabus"), ("Vacancy of clerks", "notification"), ("Photographs", "other"))


@register(f"SELECT o_orderkey, CASE o_orderkey % {len(_TITLES)} " + " ".join(f"WHEN {i} THEN '{kind}'" for i, (_, kind) in enumerate(_TITLES[:-1])) + " ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'other' ELSE 'corrigendum' END END AS kind FROM orders")
def kinds_of_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of notices by the rules in their order, title first, else the first page."""
    k = (F.col("o_orderkey") % len(_TITLES) + 1).cast("int")
    title = F.element_at(F.array(*[F.lit(t) for t, _ in _TITLES]), k)
    bare = F.col("o_orderkey") % 2 == 0
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.kind_of(F.when(bare, F.lit("12/2026")).otherwise(title), F.when(bare, title).otherwise(F.lit("Corrigendum")), listings.KINDS).alias("kind"))


_VOCABULARY = {
    "class": [
        {"id": "Unreserved", "axis": "vertical", "aliases": ["general", "unreserved"], "codes": ["UR"]},
        {"id": "OBC", "axis": "vertical", "aliases": [r"other backward class(?:es)?"], "codes": ["OBC"]},
        {"id": "BC", "axis": "vertical", "aliases": [r"backward class(?:es)?"], "codes": ["BC"], "jurisdictions": ["F", "O"]},
        {"id": "all", "axis": "all", "aliases": [r"all (?:categories|candidates)"]},
    ],
    "alias": [{"to": "OBC", "codes": ["SEBC"], "jurisdictions": ["O"]}],
}


@register("""WITH x AS (SELECT o_orderkey, o_orderkey % 7 AS k, o_orderstatus AS p FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN 'Unreserved,OBC' WHEN 1 THEN 'OBC' WHEN 2 THEN CASE WHEN p IN ('F', 'O') THEN 'BC' ELSE '' END WHEN 3 THEN CASE WHEN p = 'O' THEN 'OBC' ELSE '' END WHEN 4 THEN '' WHEN 5 THEN 'Unreserved' ELSE 'all' END AS classes,
CASE k WHEN 1 THEN 'OBC' WHEN 2 THEN CASE WHEN p IN ('F', 'O') THEN 'BC' END WHEN 3 THEN CASE WHEN p = 'O' THEN 'OBC' END WHEN 5 THEN 'Unreserved' WHEN 6 THEN 'all' END AS single FROM x""")
def scoped_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes that texts name, by place; the longest match counts, a subclass is another class (S3, M6)."""
    texts = ("Rs. 500 for General and OBC", "Other Backward Classes only", "Backward classes, BC", "SEBC candidates", "BC-A and OBC - II, debug", "UR: all categories, general", "All candidates")
    k = (F.col("o_orderkey") % len(texts) + 1).cast("int")
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*[F.lit(t) for t in texts]), k).alias("text"), F.col("o_orderstatus").alias("place"))
    found = vocabulary.with_classes(x, "o_orderkey", "text", "place", vocabulary.spellings(_VOCABULARY))
    return found.select("o_orderkey", F.array_join("classes", ",").alias("classes"), "single")

"""Notices ranked for records, heads without a class, dates in Indic scripts, merge rules, work in order of waiting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as tx
from ..operators import headers, merge, ranking
from ..registry import register, table


@register("""WITH p AS (SELECT o_custkey, o_orderkey, (o_orderkey % 100) / 100.0 AS share, CASE o_orderpriority WHEN '1-URGENT' THEN 3.0 WHEN '2-HIGH' THEN 1.5 WHEN '3-MEDIUM' THEN 0.3 ELSE 0.5 END AS k,
CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS d, 2000 + o_custkey % 3 AS ry, CASE WHEN o_orderkey % 3 <> 0 THEN 2000 + o_orderkey % 5 END AS ny FROM orders),
s AS (SELECT *, date_diff('day', d, DATE '2001-09-01') AS age FROM p WHERE share >= 0.45 AND (ny IS NULL OR ny IN (ry, ry - 1))),
r AS (SELECT o_custkey, o_orderkey, round(10 * share + k + CASE WHEN age IS NULL THEN 0 WHEN age < 200 THEN 2 WHEN age < 400 THEN 1 WHEN age > 800 THEN -1 ELSE 0 END + CASE WHEN ny = ry THEN 1.5 ELSE 0 END, 2) AS score FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, o_orderkey) AS place FROM r)
SELECT o_custkey, o_orderkey, CAST(score AS DOUBLE) AS score, CAST(place AS INTEGER) AS place FROM o WHERE place <= 6""")
def notice_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notices likeliest to be about a record: shared words, kind, age, year; other cycles are out."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "notification").when(F.col("o_orderpriority") == "2-HIGH", "schedule").when(F.col("o_orderpriority") == "3-MEDIUM", "answer_key").otherwise("unheard of")
    key = F.col("o_orderkey")
    title = F.when(key % 3 != 0, F.concat(F.lit("Notice of "), (2000 + key % 5 + 10).cast("string"))).otherwise("Notice 12000")
    back = lambda years: F.transform(years, lambda y: y - 10)  # noqa: E731 - the driver's days are ten years before the years that count
    pairs = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", ((key % 100) / 100.0).alias("share"), kind.alias("kind"), F.when(key % 11 != 0, F.to_date("o_orderdate")).alias("published"),
        F.array((2000 + F.col("o_custkey") % 3).cast("int")).alias("record_years"), back(ranking.years_of(title)).alias("title_years"),
    )
    return ranking.ranked(pairs, "o_custkey", "o_orderkey", today=F.lit("2001-09-01").cast("date"))


@register("""WITH h AS (SELECT c_custkey, 'BC-' || chr(CAST(65 + c_nationkey % 26 AS INTEGER)) AS head FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'Zone ' || c_nationkey FROM customer)
SELECT head, count(DISTINCT c_custkey) AS tables, min(c_custkey) AS first FROM h GROUP BY head""")
def unmapped_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads over counts that name no known class, with where they stand."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    new = F.concat(F.lit("BC-"), F.char(F.lit(65) + nation % 26))
    header = F.array(F.lit("Name of post"), F.lit("UR"), new, F.lit("Tota l"), F.lit("Sl. No"), F.concat(F.lit("Zone "), nation.cast("string")), F.lit("A head that is much too long"), F.lit("Remarks"))
    cell = key.cast("string")
    row = lambda n: F.array(F.lit("Clerk"), cell, F.when(key % 3 == 0, "see below").otherwise(cell), cell, cell, F.concat(cell, F.lit(" (3)")) if n else F.lit("-"), cell, cell)
    grids = table(spark, sf_dir, "customer").select("c_custkey", header.alias("header"), F.array(row(0), row(1)).alias("rows"))
    return headers.worklist(grids, "c_custkey", "header", "rows")


@register("""SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def indic_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in Devanagari, Bengali or Tamil digits with Devanagari months, read as days."""
    d, key = F.to_date("o_orderdate"), F.col("o_orderkey")
    spelled = [s.split() for s in tx.INDIC_MONTHS.values()]
    month = F.element_at(F.array(*[F.when(key % 2 == 0, s[0]).otherwise(s[-1]) for s in spelled]), F.month(d))
    digits = lambda c, zero: F.translate(c, "0123456789", "".join(chr(ord(zero) + i) for i in range(10)))
    script = lambda c: F.when(key % 3 == 0, digits(c, "०")).when(key % 3 == 1, digits(c, "০")).otherwise(digits(c, "௦"))
    text = F.concat(F.lit("दिनांक "), script(F.day(d).cast("string")), F.lit(" "), month, F.lit(" "), script(F.year(d).cast("string")), F.lit(" को"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_day_first(tx.western_dates(text)).cast("string").alias("day"))


_RULES = """f AS (SELECT o_custkey AS record, 'mode' AS path, CASE o_orderkey % 4 WHEN 0 THEN 'pen_paper' WHEN 1 THEN 'omr' WHEN 2 THEN 'unknown' ELSE CASE WHEN o_custkey % 5 = 0 THEN 'computer' ELSE 'omr' END END AS value FROM orders
UNION ALL SELECT o_custkey, 'link', 'https://site' || o_custkey % 7 || '.example' || CASE o_orderkey % 3 WHEN 0 THEN '/' WHEN 1 THEN '/jobs/' ELSE CASE WHEN o_custkey % 4 = 0 THEN '/other/x' ELSE '/jobs/register' END END FROM orders
UNION ALL SELECT o_custkey, 'checked', CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders)"""
_MERGED = f"""{_RULES}, k AS (SELECT DISTINCT record, path, value FROM f WHERE value <> 'unknown'),
less AS (SELECT a.record, a.path, a.value FROM k a JOIN k b USING (record, path) WHERE (a.value = 'pen_paper' AND b.value = 'omr') OR (a.path = 'link' AND a.value <> b.value AND a.value LIKE '%/' AND starts_with(b.value, a.value)) OR (a.path = 'checked' AND a.value < b.value)),
t AS (SELECT * FROM k EXCEPT SELECT * FROM less), n AS (SELECT record, path, count(*) AS n, min(value) AS value FROM t GROUP BY ALL)"""


def _rule_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    mode = F.when(key % 4 == 0, "pen_paper").when(key % 4 == 1, "omr").when(key % 4 == 2, "unknown").when(customer % 5 == 0, "computer").otherwise("omr")
    page = F.when(key % 3 == 0, "/").when(key % 3 == 1, "/jobs/").when(customer % 4 == 0, "/other/x").otherwise("/jobs/register")
    link = F.concat(F.lit("https://site"), (customer % 7).cast("string"), F.lit(".example"), page)
    parts = [("mode", mode), ("link", link), ("checked", F.to_date("o_orderdate").cast("string"))]
    facts = F.explode(F.array(*[F.struct(F.lit(p).alias("path"), v.alias("value")) for p, v in parts])).alias("f")
    return table(spark, sf_dir, "orders").select(customer.alias("record"), facts).select("record", "f.*")


@register(f"""WITH {_MERGED} SELECT f.record, f.path, CASE WHEN max(n.n) IS NULL THEN 'unknown' WHEN max(n.n) = 1 THEN max(n.value) END AS value, coalesce(max(n.n), 0) > 1 AS conflict
FROM f LEFT JOIN n ON f.record = n.record AND f.path = n.path GROUP BY f.record, f.path""")
def merge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records merged by the rules: narrower values, links inside a folder, the latest of dates (M8)."""
    return merge.merge_facts(_rule_facts(spark, sf_dir), "record", latest=("checked",))


@register(f"""WITH {_MERGED}, m AS (SELECT record, path, value FROM n WHERE n = 1)
SELECT record, path, value FROM k WHERE path <> 'checked' AND NOT EXISTS (SELECT 1 FROM m WHERE m.record = k.record AND m.path = k.path AND (m.value = k.value OR (k.value = 'pen_paper' AND m.value = 'omr') OR (k.path = 'link' AND k.value LIKE '%/' AND starts_with(m.value, k.value))))""")
def merge_rules_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge lost: facts that the record states neither as they are nor by more (U4)."""
    facts = _rule_facts(spark, sf_dir).filter("path <> 'checked'")
    return merge.lost(facts, merge.merge_facts(facts, "record").filter("NOT conflict"), ["record", "path", "value"])


@register("""WITH c AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1), x AS (SELECT c_custkey, last, 1 + c_custkey % 7 AS cost FROM customer LEFT JOIN c ON c_custkey = o_custkey),
w AS (SELECT *, coalesce(sum(cost) OVER (ORDER BY last NULLS FIRST, c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM x)
SELECT c_custkey, CAST(last AS VARCHAR) AS last, CAST(spent AS DOUBLE) AS spent FROM w WHERE spent <= 3000""")
def longest_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The work of a run by budget: never done first, then what waits longest."""
    cursors = table(spark, sf_dir, "orders").filter("o_custkey % 3 <> 0").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.to_date("o_orderdate")).alias("last"))
    work = table(spark, sf_dir, "customer").select("c_custkey")
    return ranking.longest_waiting(work, cursors, "c_custkey", (1 + F.col("c_custkey") % 7).cast("double"), 3000.0).withColumn("last", F.col("last").cast("string"))

"""One value out of many documents, records merged and compared. Documents are order lines, entities customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge, survivorship
from ..registry import register, table


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    kinds = [("vacancies", F.when(F.col("o_totalprice") > 200000, F.round("o_totalprice"))), ("fee", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderkey").cast("double"))), ("pay", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("double")))]
    parts = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in kinds])).alias("x")
    return o.select(F.col("o_custkey").alias("exam"), F.year("o_orderdate").alias("cycle"), "o_orderkey", "o_orderstatus", parts).select("exam", "cycle", "o_orderkey", "o_orderstatus", "x.*")


_TERMS = """t AS (SELECT o_custkey AS exam, year(o_orderdate) AS cycle, o_orderkey, o_orderstatus, 'vacancies' AS field, CASE WHEN o_totalprice > 200000 THEN round(o_totalprice) END AS value FROM orders
UNION ALL SELECT o_custkey, year(o_orderdate), o_orderkey, o_orderstatus, 'fee', CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderkey AS DOUBLE) END FROM orders
UNION ALL SELECT o_custkey, year(o_orderdate), o_orderkey, o_orderstatus, 'pay', CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS DOUBLE) END FROM orders)"""


@register(f"""WITH {_TERMS}, r AS (SELECT *, row_number() OVER (PARTITION BY exam, cycle, field ORDER BY CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END DESC, o_orderkey DESC) AS n, count(*) OVER (PARTITION BY exam, cycle, field) - 1 AS alternatives FROM t WHERE value IS NOT NULL)
SELECT exam, cycle, field, value, o_orderkey AS source, alternatives FROM r WHERE n = 1""")
def profile_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of each field of a cycle by rank of its document."""
    rank = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    x = survivorship.pick(_terms(spark, sf_dir).filter("value IS NOT NULL"), ["exam", "cycle", "field"], [rank.desc(), F.desc("o_orderkey")])
    return x.select("exam", "cycle", "field", "value", F.col("o_orderkey").alias("source"), "alternatives")


_CARRIED = f"""{_TERMS}, c AS (SELECT *, max(cycle) OVER (PARTITION BY exam) AS cur FROM t),
v AS (SELECT * FROM c WHERE value IS NOT NULL AND (cycle = cur OR field NOT IN ('vacancies', 'fee'))),
r AS (SELECT *, row_number() OVER (PARTITION BY exam, field ORDER BY cycle DESC, o_orderkey DESC) AS n, count(*) OVER (PARTITION BY exam, field, cycle) - 1 AS alternatives FROM v),
p AS (SELECT exam, field, value, alternatives, CASE WHEN cycle < cur THEN cycle END AS carried_from FROM r WHERE n = 1)"""


def _carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivorship.carried(_terms(spark, sf_dir), "exam", "field", "cycle", "value", [F.desc("o_orderkey")], ("vacancies", "fee"))


@register(f"WITH {_CARRIED} SELECT * FROM p")
def carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current cycle's values, and older ones of fields that stay."""
    return _carried(spark, sf_dir).select("exam", "field", "value", "alternatives", "carried_from")


@register(f"""WITH {_CARRIED}, e(f, i) AS (VALUES ('vacancies', 1), ('fee', 2), ('pay', 3), ('selection', 4))
SELECT c_custkey AS exam, string_agg(f, ',' ORDER BY i) AS gaps FROM customer CROSS JOIN e LEFT JOIN p ON p.exam = c_custkey AND p.field = f WHERE p.field IS NULL GROUP BY 1""")
def gap_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each profile lacks."""
    entities = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("exam"))
    g = survivorship.gaps(_carried(spark, sf_dir), entities, "exam", "field", ["vacancies", "fee", "pay", "selection"])
    return g.select("exam", F.array_join("gaps", ",").alias("gaps"))


@register("""WITH c AS (SELECT l_orderkey AS doc, l_returnflag AS field, CASE WHEN l_linenumber % 5 = 4 THEN 'month' ELSE 'day' END AS g, l_discount AS hint, l_linenumber AS page, CAST(l_quantity AS BIGINT) AS value FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, field ORDER BY hint DESC, page, value) AS n, count(*) OVER (PARTITION BY doc, field) - 1 AS rejected, min(value) OVER (PARTITION BY doc, field) <> max(value) OVER (PARTITION BY doc, field) AS conflict FROM c WHERE g = 'day'),
m AS (SELECT doc, field, count(*) AS notes FROM c WHERE g = 'month' GROUP BY 1, 2), a AS (SELECT DISTINCT doc, field FROM c)
SELECT a.doc, a.field, r.value, coalesce(r.rejected, 0) AS rejected, coalesce(r.conflict, false) AS conflict, coalesce(m.notes, 0) AS notes FROM a LEFT JOIN r ON r.doc = a.doc AND r.field = a.field AND n = 1 LEFT JOIN m ON m.doc = a.doc AND m.field = a.field""")
def adjudicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate for each field of a document."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_returnflag").alias("field"), F.when(F.col("l_linenumber") % 5 == 4, "month").otherwise("day").alias("granularity"), F.col("l_discount").alias("hint"), F.col("l_linenumber").alias("page"), F.col("l_quantity").cast("long").alias("value"))
    return survivorship.adjudicate(x, ["doc", "field"], granularity="granularity", hint="hint", page="page", value="value", tie=[F.col("value")])


@register("""SELECT l_orderkey, arg_min(l_partkey, row(l_linenumber, l_partkey, l_suppkey)) FILTER (WHERE l_returnflag = 'R') AS part, arg_min(l_quantity, row(l_linenumber, l_partkey, l_suppkey)) FILTER (WHERE l_discount > 0.05) AS quantity FROM lineitem GROUP BY 1""")
def first_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first known value of each column in rank order."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_returnflag") == "R", F.col("l_partkey")).alias("part"), F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).alias("quantity"))
    return survivorship.first_known(x, ["l_orderkey"], ["part", "quantity"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")])


@register("""WITH a AS (SELECT c_custkey, c_mktsegment AS s, CAST(c_nationkey AS VARCHAR) AS n FROM customer), b AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'BUILDING' WHEN c_custkey % 7 > 0 THEN c_mktsegment END AS s, CAST(c_nationkey % 20 AS VARCHAR) AS n FROM customer)
SELECT 'segment' AS field, count(*) AS "both", count(*) FILTER (WHERE a.s = b.s) AS agree FROM a JOIN b USING (c_custkey) WHERE a.s IS NOT NULL AND b.s IS NOT NULL
UNION ALL SELECT 'nation', count(*), count(*) FILTER (WHERE a.n = b.n) FROM a JOIN b USING (c_custkey)""")
def cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often two tables agree where both state a value."""
    c = table(spark, sf_dir, "customer")
    a = c.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    b = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "BUILDING").when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment")).alias("segment"), (F.col("c_nationkey") % 20).alias("nation"))
    return survivorship.agreement(a, b, ["c_custkey"], ["segment", "nation"])


@register("SELECT p_brand, p_name, string_agg(p_partkey, ',' ORDER BY p_partkey) AS members FROM part GROUP BY 1, 2 HAVING count(*) > 1 AND count(DISTINCT CASE WHEN p_type <> 'SMALL' THEN p_type END) <= 1")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are one: the same name and brand, and no two kinds."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type")
    return merge.duplicate_groups(part, ["p_brand", "p_name"], "p_partkey", "p_type", ("SMALL",)).withColumn("members", F.array_join(F.transform("members", lambda m: m.cast("string")), ","))


_VARIANTS = ("box", "gear", "i", "ii")


@register("""WITH w AS (SELECT p_partkey AS id, p_brand, CASE WHEN p_partkey % 5 = 0 THEN ['alpha', string_split(lower(p_name), ' ')[1]] ELSE ['alpha', string_split(lower(p_name), ' ')[1], CASE p_partkey % 5 WHEN 1 THEN 'box' WHEN 2 THEN 'i' WHEN 3 THEN 'other' ELSE 'gear' END] END AS w FROM part),
f AS (SELECT id, p_brand, w FROM w WHERE len(w) = 2 AND len(list_filter(w, lambda x: x IN ('box', 'gear', 'i', 'ii'))) = 0),
p AS (SELECT id, p_brand, w[1:2] AS stem, w[3] AS extra FROM w WHERE len(w) = 3 AND w[3] IN ('box', 'gear', 'i', 'ii') AND w[2] NOT IN ('box', 'gear', 'i', 'ii')),
j AS (SELECT f.id AS family, p.id AS part, extra FROM f JOIN p ON f.p_brand = p.p_brand AND f.w = p.stem)
SELECT family, string_agg(part, ',' ORDER BY part) AS parts FROM j GROUP BY family HAVING count(*) >= 2 AND count(DISTINCT extra) = count(*)""")
def family_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are a family's name plus a variant."""
    first = F.split(F.lower("p_name"), " ").getItem(0)
    k = F.col("p_partkey") % 5
    words = F.when(k == 0, F.array(F.lit("alpha"), first)).otherwise(F.array(F.lit("alpha"), first, F.when(k == 1, "box").when(k == 2, "i").when(k == 3, "other").otherwise("gear")))
    x = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand", words.alias("words"))
    return merge.families(x, "id", "words", ["p_brand"], _VARIANTS).withColumn("parts", F.array_join(F.transform("parts", lambda p: p.cast("string")), ","))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    facts = F.explode(F.array(
        F.struct(F.lit("status").alias("path"), F.when(F.col("o_orderkey") % 4 == 0, "unknown").otherwise(F.col("o_orderstatus")).alias("value")),
        F.struct(F.lit("priority").alias("path"), F.col("o_orderpriority").alias("value")),
        F.struct(F.lit("year").alias("path"), F.when(F.col("o_orderkey") % 3 > 0, F.year("o_orderdate").cast("string")).alias("value")),
    ))
    return o.select(F.col("o_custkey").alias("record"), "o_orderkey", facts.alias("f")).select("record", "o_orderkey", "f.*")


_FACTS = """f AS (SELECT o_custkey AS record, o_orderkey, 'status' AS path, CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE o_orderstatus END AS value FROM orders
UNION ALL SELECT o_custkey, o_orderkey, 'priority', o_orderpriority FROM orders
UNION ALL SELECT o_custkey, o_orderkey, 'year', CASE WHEN o_orderkey % 3 > 0 THEN CAST(year(o_orderdate) AS VARCHAR) END FROM orders)"""
_MERGED = f"""{_FACTS}, g AS (SELECT record, path, list_sort(list(DISTINCT value) FILTER (WHERE value IS NOT NULL AND value NOT IN ('', 'unknown', 'not_announced'))) AS known, min(value) AS b FROM f GROUP BY 1, 2),
m AS (SELECT record, path, CASE WHEN coalesce(len(known), 0) = 0 THEN b WHEN len(known) = 1 THEN known[1] WHEN path = 'priority' THEN array_to_string(known, '; ') END AS value, coalesce(len(known), 0) > 1 AND path <> 'priority' AS conflict FROM g)"""


@register(f"WITH {_MERGED} SELECT * FROM m")
def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of several records as one, with what they disagree about (M8)."""
    return merge.merge_facts(_facts(spark, sf_dir), "record", additive=("priority",))


@register(f"""WITH {_MERGED} SELECT DISTINCT record, path, value FROM f WHERE value IS NOT NULL AND value NOT IN ('', 'unknown', 'not_announced') EXCEPT SELECT record, path, value FROM m""")
def merge_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known facts that a merge does not state (U4)."""
    f = _facts(spark, sf_dir)
    return merge.lost(f, merge.merge_facts(f, "record", additive=("priority",)), ["record", "path", "value"])


_SIDES = """b AS (SELECT c_custkey AS record, 'segment' AS path, c_mktsegment AS value FROM customer WHERE c_nationkey >= 4 UNION ALL SELECT c_custkey, 'state', 'open:' || c_nationkey % 3 FROM customer UNION ALL SELECT c_custkey, 'provenance.at', '1' FROM customer),
a AS (SELECT c_custkey AS record, 'segment' AS path, CASE WHEN c_custkey % 2 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS value FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT c_custkey, 'state', CASE WHEN c_custkey % 3 = 0 THEN 'shut' ELSE 'open:' || c_nationkey % 2 END FROM customer UNION ALL SELECT c_custkey, 'provenance.at', '2' FROM customer)"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    row = lambda path, value, where="true": c.filter(where).select(F.col("c_custkey").alias("record"), F.lit(path).alias("path"), value.alias("value"))
    state = lambda n: F.concat(F.lit("open:"), F.col("c_nationkey") % n)
    b = row("segment", F.col("c_mktsegment"), "c_nationkey >= 4").unionByName(row("state", state(3))).unionByName(row("provenance.at", F.lit("1")))
    a = row("segment", F.when(F.col("c_custkey") % 2 == 0, "BUILDING").otherwise(F.col("c_mktsegment")), "c_acctbal >= 0").unionByName(row("state", F.when(F.col("c_custkey") % 3 == 0, "shut").otherwise(state(2)))).unionByName(row("provenance.at", F.lit("2")))
    return b, a


_DIFF = f"""{_SIDES}, x AS (SELECT coalesce(b.record, a.record) AS record, coalesce(b.path, a.path) AS path, b.value AS before, a.value AS after FROM b FULL JOIN a ON b.record = a.record AND b.path = a.path),
d AS (SELECT *, CASE WHEN before IS NOT DISTINCT FROM after THEN 'unchanged' WHEN before IS NULL THEN 'added' WHEN after IS NULL THEN 'removed'
 WHEN regexp_matches(before, '^[a-z]+(:|$)') AND regexp_matches(after, '^[a-z]+(:|$)') AND regexp_extract(before, '^([a-z]+)(:|$)', 1) = regexp_extract(after, '^([a-z]+)(:|$)', 1) THEN 'status-change' ELSE 'changed' END AS kind, starts_with(path, 'provenance') AS bookkeeping FROM x)"""


@register(f"WITH {_DIFF} SELECT * FROM d")
def record_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two versions of records."""
    return merge.diff(*_sides(spark, sf_dir), ["record", "path"], "value", bookkeeping=("provenance",))


@register(f"WITH {_DIFF} SELECT record, count(*) AS changes FROM d WHERE kind <> 'unchanged' AND NOT bookkeeping GROUP BY 1")
def material_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a change that is not bookkeeping."""
    return merge.material(merge.diff(*_sides(spark, sf_dir), ["record", "path"], "value", bookkeeping=("provenance",)), "record")


@register("""WITH a AS (SELECT DISTINCT 0 AS k, o_custkey AS key, o_orderstatus AS v FROM orders UNION ALL SELECT DISTINCT 1, c_custkey, c_mktsegment FROM customer),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY k, v) AS n FROM a) SELECT key, v FROM n WHERE n = 1""")
def union_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outputs of several workers, the first wins."""
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("v"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("v"))
    return merge.union_first([a, b], ["key"])


@register("SELECT s_nationkey AS key, 's' AS v FROM supplier UNION ALL SELECT c_nationkey, 'c' FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey < 10) AND c_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def union_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table, and of another what it does not cover."""
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"), F.lit("s").alias("v"))
    b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("key"), F.lit("c").alias("v"))
    return merge.union_uncovered(a, b, "key")


@register("""SELECT l_orderkey, l_returnflag || '/' || l_linestatus AS key, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY 1, 2""")
def map_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of counts, summed by key (A10)."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", F.create_map(F.concat_ws("/", "l_returnflag", "l_linestatus"), F.col("l_quantity").cast("long")).alias("m"))
    return survivorship.total_by_key(x, ["l_orderkey"], "m")

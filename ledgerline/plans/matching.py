"""Matching titles and addresses with rules, linting references, counting coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..operators import discovery, lint, matching
from ..operators.matching import Rule
from ..registry import register, table

_RULES = {
    "blue": ("blue", "steel"), "green-thing": ("green",), "small": (r"small\s+[a-z]+",), "box": ("box", "widget", "gear"), "red": ("red",), "wide": (r"[a-z]+\s+(box|gear)",),
}
_NONE = {"box": ("large",)}


def _edged(p: str) -> str:
    return f"(?i)(^|[^A-Za-z])({p})([^A-Za-z]|$)"


def rules() -> list[Rule]:
    return [Rule(name, tuple(_edged(p) for p in any_), tuple(_edged(p) for p in _NONE.get(name, ())), group=2) for name, any_ in _RULES.items()]


def _rules_sql() -> str:
    spans = []
    for name, any_ in _RULES.items():
        one = [f"coalesce(list_max(list_transform(regexp_extract_all(p_name, '{_edged(p)}', 2), lambda m: length(m))), 0)" for p in any_]
        best = f"greatest({', '.join(one)}, 0)"
        for p in _NONE.get(name, ()):
            best = f"CASE WHEN regexp_matches(p_name, '{_edged(p)}') THEN 0 ELSE {best} END"
        spans.append(f"SELECT p_partkey, '{name}' AS entity, {best} AS span FROM part")
    return " UNION ALL ".join(spans)


_HITS = f"""s AS ({_rules_sql()}), b AS (SELECT *, max(span) OVER (PARTITION BY p_partkey) AS top FROM s),
h AS (SELECT p_partkey, list_sort(list(entity)) AS hits FROM b WHERE span > 0 AND span = top GROUP BY p_partkey),
a AS (SELECT p.p_partkey, p.p_type, coalesce(h.hits, []) AS hits FROM part p LEFT JOIN h USING (p_partkey))"""


@register(f"WITH {_HITS} SELECT p_partkey, array_to_string(hits, ',') AS hits FROM a")
def match_longest_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles against patterns: any, none, longest span, ties kept."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return matching.match(part, F.col("p_name"), rules()).select("p_partkey", F.array_join("hits", ",").alias("hits"))


@register(f"""WITH {_HITS} SELECT p_type, CASE len(hits) WHEN 0 THEN 'unmatched' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS state, count(*) AS n FROM a GROUP BY 1, 2""")
def classify_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many titles match one entity, several or none, by kind."""
    part = table(spark, sf_dir, "part").select("p_type", "p_name")
    return matching.classify(matching.match(part, F.col("p_name"), rules())).groupBy("p_type", "state").agg(F.count("*").alias("n"))


_SCOPES = {"blue": ("SMALL", "LARGE"), "green-thing": ("SMALL",), "red": ("LARGE",), "wide": ("SMALL", "LARGE")}


def _scoped_sql() -> str:
    parts = []
    for scope in ("SMALL", "LARGE"):
        names = ", ".join(f"'{n}'" for n, s in _SCOPES.items() if scope in s)
        parts.append(f"SELECT p_partkey, entity FROM (SELECT *, max(span) OVER (PARTITION BY p_partkey) AS top FROM s WHERE entity IN ({names})) JOIN part USING (p_partkey) WHERE span > 0 AND span = top AND contains(p_type || ' ' || p_brand, '{scope}')")
    return " UNION ".join(parts)


@register(f"WITH s AS ({_rules_sql()}), u AS ({_scoped_sql()}) SELECT p_partkey, string_agg(entity, ',' ORDER BY entity) AS hits FROM u GROUP BY 1")
def match_named_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners of every scope that a text names, together."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat_ws(" ", "p_type", "p_brand").alias("hay"))
    named = F.array_compact(F.array(*[F.when(F.contains("hay", F.lit(s)), F.lit(s)) for s in ("SMALL", "LARGE")]))
    scoped = [Rule(r.entity, r.any, r.none, _SCOPES[r.entity], r.group) for r in rules() if r.entity in _SCOPES]
    found = matching.match_any_scope(part, F.col("p_name"), scoped, named)
    return found.filter(F.size("hits") > 0).select("p_partkey", F.array_join("hits", ",").alias("hits"))


_KEYS = [("blue", "B"), ("blue box", "BB"), ("box", "X"), ("red", "R"), ("e", "E"), ("steel", "S")]
_KEYS_SQL = ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(_KEYS))


@register(f"""WITH k(i, key, v) AS (VALUES {_KEYS_SQL}), m AS (SELECT p_partkey, v, row_number() OVER (PARTITION BY p_partkey ORDER BY length(key) DESC, i) AS n FROM part JOIN k ON contains(p_name, key))
SELECT p.p_partkey, m.v AS target FROM part p LEFT JOIN m ON m.p_partkey = p.p_partkey AND n = 1""")
def map_longest_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest key that a text contains decides."""
    return table(spark, sf_dir, "part").select("p_partkey", matching.longest_key(F.col("p_name"), _KEYS).alias("target"))


_SITES = [("example.com", "com"), ("example.net", "net"), ("example.org", "org"), ("m.ththth.example.net", "one"), ("example.com/en", "com-en")]
_SITES_SQL = ", ".join(f"('{s.partition('/')[0]}', '{s.partition('/')[2]}', '{v}', {len(s)})" for s, v in _SITES)


@register(f"""WITH k(h, p, v, n) AS (VALUES {_SITES_SQL}), u AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (SELECT page_id, max(struct_pack(score := CASE WHEN host = h THEN 10000 ELSE 0 END + n, v := v)) AS b FROM u JOIN k ON (host = h OR ends_with(host, '.' || h)) AND (p = '' OR starts_with(path, '/' || p)) GROUP BY page_id)
SELECT u.page_id, m.b.v AS source FROM u LEFT JOIN m USING (page_id)""")
def suffix_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of an address by its host's suffix."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", matching.by_site(urls.host(u), urls.path(u), _SITES).alias("source"))


@register("""SELECT 'order customer' AS rule, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS value FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)
UNION ALL SELECT 'nation twice', CAST(s_nationkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM supplier GROUP BY s_nationkey HAVING count(*) > 1
UNION ALL SELECT 'segment', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'brand form', CAST(p_partkey AS VARCHAR), p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[1-3]')""")
def lint_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to what is not there, doubles, words outside a vocabulary, wrong forms."""
    t = lambda n: table(spark, sf_dir, n)
    return lint.together(
        lint.references(t("orders"), "o_orderkey", "o_custkey", t("customer").filter("c_nationkey < 12"), "c_custkey", "order customer"),
        lint.doubled(t("supplier"), "s_nationkey", "nation twice"),
        lint.outside(t("customer"), "c_custkey", "c_mktsegment", ["BUILDING", "MACHINERY"], "segment"),
        lint.like(t("part"), "p_partkey", "p_brand", "^Brand#[1-3]", "brand form"),
    )


@register("""SELECT n.n_nationkey, count(c_custkey) AS total, count(c_custkey) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders)) AS seen FROM nation n LEFT JOIN customer ON c_nationkey = n.n_nationkey GROUP BY 1""")
def coverage_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each parent has been seen (A2)."""
    seen = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(seen, "c_custkey", "left").withColumn("seen", F.coalesce("hit", F.lit(False)))
    return lint.coverage(table(spark, sf_dir, "nation"), "n_nationkey", customers, "c_nationkey")


@register("SELECT coalesce(c_mktsegment, '-') AS value, count(*) AS n FROM customer GROUP BY 1")
def catalogue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lint.counts(table(spark, sf_dir, "customer"), "c_mktsegment")


@register("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def missing_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that nothing of a kind refers to."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(orders, "c_custkey", "left_anti").select("c_custkey", "c_name")


_WORDS = "list_filter(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda w: length(w) > 2)"


@register("""WITH w AS (SELECT DISTINCT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS word FROM documents)
SELECT word, count(*) AS df, ln((SELECT count(*) FROM documents) / count(*)) AS idf FROM w GROUP BY word""")
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document frequency of every word (A5)."""
    docs = table(spark, sf_dir, "documents").select(tx.words(F.col("text")).alias("words"))
    return matching.idf(docs, "words", "doc_id")


@register(f"""WITH p AS (SELECT p_partkey, p_brand || p_type AS b, {_WORDS.format("p_name")} AS w FROM part),
x AS (SELECT p_partkey, b, unnest(list_distinct(w)) AS word FROM p), f AS (SELECT word, ln((SELECT count(*) FROM part) / count(*)) AS idf FROM x GROUP BY word),
l AS (SELECT x.*, idf FROM x JOIN f USING (word)), m AS (SELECT p_partkey, sum(idf) AS mass FROM l GROUP BY 1),
j AS (SELECT l.p_partkey, x.p_partkey AS other, sum(idf) AS w, count(*) AS common FROM l JOIN x ON l.word = x.word AND l.b = x.b GROUP BY 1, 2),
s AS (SELECT p_partkey, other, w / mass AS share, common FROM j JOIN m USING (p_partkey) WHERE w / mass >= 0.45),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY share DESC, other) AS place FROM s)
SELECT p_partkey, other, round(share, 6) AS share, common, place FROM r WHERE place <= 6""")
def tfidf_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most similar titles of each, among those that share a block."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.filter(tx.words(F.col("p_name")), lambda w: F.length(w) > 2).alias("words"), F.array(F.concat("p_brand", "p_type")).alias("blocks"))
    weights = matching.idf(part, "words", "p_partkey")
    found = matching.similar(part, part.withColumnRenamed("p_partkey", "other"), weights, id_l="p_partkey", id_r="other", words="words", blocks="blocks")
    return found.withColumn("share", F.round("share", 6))


@register("""WITH r AS (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM part WHERE NOT regexp_matches(p_name, '(?i)(box|gear)'))
SELECT p_brand, max(n) AS n, string_agg(p_name, '|' ORDER BY k) AS examples FROM r WHERE k <= 3 GROUP BY p_brand""")
def unmapped_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What no rule maps, with examples."""
    part = table(spark, sf_dir, "part").filter(~F.col("p_name").rlike("(?i)(box|gear)"))
    return discovery.examples(part, ["p_brand"], F.col("p_name"), [F.col("p_partkey")]).withColumn("examples", F.array_join("examples", "|"))


@register("""WITH x AS (SELECT o_custkey % 50 AS body, o_orderpriority AS name, o_orderstatus = 'F' AS strong, year(o_orderdate) AS y FROM orders),
g AS (SELECT body, count(*) AS "rows", count(*) FILTER (WHERE strong) AS strong, count(DISTINCT y) AS years FROM x GROUP BY body),
m AS (SELECT body, name, row_number() OVER (PARTITION BY body ORDER BY count(*) DESC, name DESC) AS k FROM x GROUP BY body, name)
SELECT body, "rows", g.strong, years, "rows" + 2 * g.strong + years AS score, m.name FROM g JOIN m USING (body) WHERE m.k = 1 AND ("rows" >= 2 OR g.strong > 0)""")
def proposal_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series worth proposing, with score and usual name."""
    x = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("body"), F.col("o_orderpriority").alias("name"), "o_orderstatus", "o_orderdate")
    return discovery.proposals(x, ["body"], "name", F.col("o_orderstatus") == "F", F.year("o_orderdate"))


@register("""WITH w AS (SELECT p_partkey, p_brand, string_split(lower(p_name), ' ') AS w FROM part), f AS (SELECT *, array_to_string(list_transform(w, lambda x: x[1:1]), '') AS i FROM w WHERE len(w) >= 2)
SELECT 'a' || a.p_partkey AS acronym, 'f' || f.p_partkey AS full_name FROM f JOIN f a ON a.p_brand = f.p_brand AND a.i = f.i""")
def acronym_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initials against full names of one group (J15). Every name is also cut down to its initials, which play the
    acronyms."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.split(F.lower("p_name"), " ").alias("words"))
    short = p.select(F.concat(F.lit("a"), F.col("p_partkey")).alias("id"), "p_brand", F.array(discovery.initials(F.col("words"))).alias("words"))
    full = p.select(F.concat(F.lit("f"), F.col("p_partkey")).alias("id"), "p_brand", "words")
    return discovery.acronyms(short.unionByName(full), "id", "words", ["p_brand"]).withColumnRenamed("full", "full_name")

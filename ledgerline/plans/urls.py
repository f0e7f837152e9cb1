"""Addresses of pages: identity, cache keys, domains, keep-first by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators.selection import keep_first
from ..registry import register, table

_PARTS = """
  SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS s,
         lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS h,
         CASE WHEN regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/'
              ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) END AS p,
         regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q FROM pages
"""
_CANONICAL = "s || '://' || h || p || CASE WHEN q = '' THEN '' ELSE '?' || q END"


@register(f"WITH x AS ({_PARTS}) SELECT page_id, {_CANONICAL} AS canonical FROM x")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical(F.col("url")).alias("canonical"))


@register(f"""WITH x AS ({_PARTS}),
k AS (SELECT *, array_to_string(list_sort(list_filter(string_split(q, '&'), lambda v: v <> '' AND NOT regexp_matches(v, '(?i)^(utm_|fbclid|gclid|ref|source)'))), '&') AS kept FROM x)
SELECT page_id, s || '://' || h || p || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS cache_key FROM k""")
def url_cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.cache_key(F.col("url")).alias("cache_key"))


@register(f"WITH x AS ({_PARTS}) SELECT page_id, sha256({_CANONICAL}) AS id, sha256({_CANONICAL} || chr(10) || 'title ' || page_id) AS titled_id FROM x")
def url_identity_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit("title "), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", urls.notice_id(F.col("url")).alias("id"), urls.notice_id(F.col("url"), title).alias("titled_id"))


@register(f"""WITH x AS ({_PARTS}), l AS (SELECT page_id, h, string_split(h, '.') AS a FROM x),
d AS (SELECT page_id, h, CASE WHEN len(a) >= 3 AND a[len(a) - 1] IN ('ac','co','com','edu','gov','net','nic','org','res') THEN 3 ELSE 2 END AS k, a FROM l)
SELECT array_to_string(a[greatest(1, len(a) - k + 1):], '.') AS domain, count(*) AS pages, count(DISTINCT h) AS hosts FROM d GROUP BY 1""")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = urls.host(F.col("url"))
    return table(spark, sf_dir, "pages").select(h.alias("h"), urls.domain(h).alias("domain")).groupBy("domain").agg(F.count("*").alias("pages"), F.count_distinct("h").alias("hosts"))


@register("""WITH k AS (SELECT page_id, lower(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '(?i)^https?://(www\\.)?', ''), '/+$', '')) AS key FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS n FROM k) SELECT key, page_id FROM n WHERE n = 1""")
def url_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "pages").select(urls.site_key(F.col("url")).alias("key"), "page_id")
    return keep_first(keyed, ["key"], [F.col("page_id")])


@register(f"""WITH x AS ({_PARTS}) SELECT page_id, CASE WHEN h LIKE 'blog.%' OR h LIKE '%.blog' THEN 'third_party' WHEN regexp_matches(p, '(?i)\\.(pdf|docx?)$') THEN 'file'
 WHEN regexp_matches(q, '(^|&)(page|ref)=') THEN 'volatile' ELSE 'page' END AS kind FROM x""")
def link_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sort of link an address is (F15): on another's site, a file, one that changes, a page."""
    u = F.col("url")
    h = urls.host(u)
    kind = F.when(F.startswith(h, F.lit("blog.")) | F.endswith(h, F.lit(".blog")), "third_party").when(urls.path(u).rlike(r"(?i)\.(pdf|docx?)$"), "file").when(urls.query(u).rlike("(^|&)(page|ref)="), "volatile").otherwise("page")
    return table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"))

"""What an address turned out to be, and what follows for the records that hold it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls

FILE = r"(?i)\.(pdf|docx?|xlsx?|zip)($|\?)"
SOFT_404 = r"(?i)page\s+not\s+found|404\s+error|/404\b"


def state(status: Column, final_url: Column, head: Column) -> Column:
    """blocked, not_found, error, soft_404 or ok."""
    return (
        F.when(status.isin(401, 403, 429, 503), "blocked").when(status.isin(404, 410), "not_found").when(status >= 400, "error")
        .when(final_url.rlike(SOFT_404) | F.substring(F.coalesce(head, F.lit("")), 1, 3000).rlike(SOFT_404), "soft_404").otherwise("ok")
    )


def verified(status: Column, url: Column, final_url: Column, head: Column) -> Column:
    """The same, and redirected where the answer came from another host."""
    bare = lambda u: F.regexp_replace(urls.host(u), r"^www\.", "")
    found = state(status, final_url, head)
    return F.when((found == "ok") & (bare(url) != bare(final_url)), "redirected").otherwise(found)


def fetched(status: Column, content_type: Column, length: Column, most: int = 30_000_000) -> Column:
    """What became of a document's fetch."""
    return F.when(status.isNull() | (status >= 400), "failed").when(length > most, "too_large").when(~F.coalesce(content_type, F.lit("")).rlike("(?i)pdf"), "not_pdf").otherwise("fetched")


def kinds(links: DataFrame, checks: DataFrame, url: str = "url") -> DataFrame:
    """Links with kind: file, portal, page, broken, unknown (J21). A link that was not checked, or whose check says
    nothing sure, changes nothing."""
    c = checks.select(F.col(url).alias("__url"), "state", F.col("kind").alias("__kind"))
    x = links.join(c, links[url] == c["__url"], "left")
    ok = F.coalesce(F.col("state") == "ok", F.lit(False))
    kind = F.when(F.col(url).rlike(FILE) & ~ok, "file").when(F.col("state").isin("not_found", "soft_404"), "broken").when(ok, F.coalesce("__kind", F.lit("unknown"))).otherwise("unknown")
    return x.withColumn("kind", kind).drop("__url", "__kind", "state")


def newest_year(text: Column) -> Column:
    """The latest year that a text names; none counts as now."""
    return F.coalesce(F.array_max(F.regexp_extract_all(text, F.lit(r"(?<![0-9])(20[0-9]{2})(?![0-9])"), F.lit(1))).cast("int"), F.lit(9999))


def apply_links(df: DataFrame, page: str, text: str, order: str, most: int = 5) -> DataFrame:
    """The links of a page that lead to an application, a stale cycle's last."""
    w = Window.partitionBy(page).orderBy(newest_year(F.col(text)).desc(), order)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def with_parent(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Rows of detail pages under their listing row: titles joined, the child's day first."""
    p = parents.select(F.col("url").alias("parent_url"), F.col("title").alias("__t"), F.col("published").alias("__p"))
    x = children.join(p, "parent_url")
    return x.withColumns({"title": F.when(F.col("title") == F.col("__t"), F.col("title")).otherwise(F.concat_ws(" - ", "__t", "title")), "published": F.coalesce("published", "__p")}).drop("__t", "__p")


def word_overlap(df: DataFrame, by: str, words_a: str, words_b: str, order: str, most: int = 4) -> DataFrame:
    """The rows of a page that share most words with their record, at least one."""
    x = df.withColumn("overlap", F.size(F.array_intersect(words_a, words_b))).filter("overlap > 0")
    return x.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("overlap"), order))).filter(F.col("__n") <= most).drop("__n")


def page_trials(links: DataFrame, body: str, wanted: str, boring: str, known: DataFrame, most: int = 8) -> DataFrame:
    """The pages of a body worth a trial fetch: wanted by their words, not boring, not known, ``most`` a body."""
    x = links.withColumn("key", urls.site_key(F.col("url"))).filter(F.concat_ws(" ", "text", "url").rlike(wanted) & ~F.col("url").rlike(boring))
    x = x.join(known.select(urls.site_key(F.col("url")).alias("key")).distinct(), "key", "left_anti").dropDuplicates([body, "key"])
    return x.withColumn("__n", F.row_number().over(Window.partitionBy(body).orderBy(F.length("url"), "url"))).filter(F.col("__n") <= most).drop("__n")

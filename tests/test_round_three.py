"""What larger tables and odd rows brought up: titles, numbers, crowds of equal names."""

import random
import threading

import duckdb
from pyspark.sql import functions as F

from ledgerline import catalog
from ledgerline.operators import matching, merge


def against_sql(spark, where, name, table, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{where}/{table}.parquet")
    got = catalog.queries()[name](spark, str(where))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{where}/{table}.parquet/*.parquet'")
        want = db.execute(catalog.oracle_sql()[name])
        columns = [d[0] for d in want.description]
        return sorted(map(tuple, got.select(*columns).collect()), key=str), sorted(want.fetchall(), key=str)


def test_titles_cut_within_a_reference(spark, tmp_path):
    titles = ["Cut &amp;&amp", "Cut &am", "A &amp;B &quot;x&quot;", "&lt;b&gt; &nbsp;", "&ampere;", "a  b \t\n c", "", " &amp;amp; "]
    rows = [(i, "u", f"<html><head><title>{t}</title></head><body><p>x</p></body></html>") for i, t in enumerate(titles)] + [(90, "u", None), (91, "u", "<p>no title</p>")]
    got, want = against_sql(spark, tmp_path, "html_title", "pages", rows, "page_id long, url string, html string")
    assert got == want and (0, "Cut &&amp") in got and (90, None) in got


def test_numbers_of_any_size(spark, tmp_path):
    rows = [(k,) for k in (0, 1, 2, 3, 20_000, 20_003, 89_999, 899_999, 8_100_000_002, 700_000_000_001)]
    got, want = against_sql(spark, tmp_path, "number_cells", "customer", rows, "c_custkey long")
    assert got == want and (20_003, 20_003 * 12345, 20_003 * 7, 20_003) in got


def within(spark, seconds, df):
    stop = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        return df.collect()
    finally:
        stop.cancel()


def test_families_of_crowds(spark):
    """60,000 names of one family are not paired with 60,000 parts; lists with two parts alike are none, others stay whole."""
    crowd = spark.range(120_000).select("id", F.lit("x").alias("b"), F.when(F.col("id") % 2 == 0, F.array(F.lit("alpha"), F.lit("hot"))).otherwise(F.array(F.lit("alpha"), F.lit("hot"), F.lit("box"))).alias("words"))
    rows = [(200_000 + i, "y", w.split()) for i, w in enumerate(["Big Bag", "Big Bag", "Big Bag box", "Big Bag gear", "Big Bag box gear", "Big Hat", "Big Hat ii", "Big Bag bb", "Big Box", "Big Cap", "Big Cap box", "Big Cap box", "Big Cap ii"])]
    df = crowd.unionByName(spark.createDataFrame(rows, "id long, b string, words array<string>"))
    got = within(spark, 60, merge.families(df, "id", "words", ["b"], ("box", "gear", "i", "ii")))
    assert sorted(map(tuple, got)) == [(200_000, [200_002, 200_003, 200_004]), (200_001, [200_002, 200_003, 200_004])]


def test_similar_titles_of_crowds(spark, tmp_path):
    """60,000 equal titles of one block are one class, each row with the same six; small crowds as in the SQL."""
    df = spark.range(60_000).select("id", F.array(F.lit("hot"), F.lit("bolt")).alias("words"), F.array(F.lit("b")).alias("blocks"))
    weights = spark.createDataFrame([("hot", 1.0), ("bolt", 2.0)], "word string, idf double")
    found = matching.similar(df, df.withColumnRenamed("id", "other"), weights, id_l="id", id_r="other", words="words", blocks="blocks")
    tops = within(spark, 60, found.groupBy("other", "place", "share", "common").agg(F.count("*").alias("n")))
    assert sorted(map(tuple, tops)) == [(i, i + 1, 1.0, 2, 60_000) for i in range(6)]
    r = random.Random(5)
    rows = [(i, f"{r.choice('hot cold old new'.split())} {r.choice('bolt ring bolt bolt'.split())}", r.choice("AB"), "T") for i in range(120)] + [(200, None, "A", "T"), (201, "hot bolt", None, "T"), (202, "a b", "A", "T")]
    got, want = against_sql(spark, tmp_path, "tfidf_match", "part", rows, "p_partkey long, p_name string, p_brand string, p_type string")
    assert [(a, b, round(c, 6), d, e) for a, b, c, d, e in got] == [(a, b, round(c, 6), d, e) for a, b, c, d, e in want] and got

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, "The cat sat on the mat and looked at the moon.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \n\t ", "de", None),
    (5, "Der Hund und die Katze sind im Haus und schlafen.", "de", "b"),
    (5, "Der Hund und die Katze sind im Haus und schlafen.", "de", "b"),
    (None, "Keine Nummer hat dieser Text.", "de", "c"),
    (6, LONG, "en", "c"),
    (7, f"Before it {ITEM} and after it.", "en", "a"),
    (8, "12345 --- !!!", None, None),
    (9, "é", "fr", "a"),
    (10, "The cat sat on the mat and looked at the moon.", "en", "c"),
    (11, "Some text\nReleased under the MIT License.\nmore text", "en", "a"),
]
CLASH = ("score", "shard", "slot", "row", "rank", "h", "words", "text_hash", "fp", "component_id", "copies", "__gone_id", "lang_pred", "u", "size")


def tables(spark, where, rows):
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long"))
    for c in CLASH:
        docs = docs.withColumn(c, F.lit("clash"))
    docs.write.parquet(f"{where}/documents.parquet")
    n = len(rows)
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)] + [(1, None, None), (None, 1, 0)] if n else [], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "too short")] if n else [], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    pages = [(1, "u", "<html><body><nav><a>x</a></nav><article><p>Main&nbsp;text &amp; more,<br>and <b>bo</b>ld.</p></article>"), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<p" + "<div>" * 3000 + "deep"), (5, "u", "a < b \"' <!-- open")]
    spark.createDataFrame(pages if n else [], "page_id long, url string, html string").withColumn("text", F.lit("clash")).write.parquet(f"{where}/pages.parquet")
    return str(where)


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("messy"), ROWS)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("nothing"), [])

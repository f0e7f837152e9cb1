import pytest
from pyspark.sql import functions as F

from ledgerline.sources import files, html, listings, sinks
from ledgerline.sources.listings import Recipe

PAGE = """<html><head><title>Board</title></head><body><nav><ul><li><a href="/home">Home</a><li><a href="/n1.pdf">Menu notice</a></ul></nav>
<section id="list"><p><a href="a.pdf?x=1#top">Result of CGL (2 MB)</a> 05/02/2025</p><p>Schedule of tests <a href="b.pdf">Read More</a></p><p><a href="javascript:x()">Notice</a></p>
<p><a href="/about">About us</a></p><p><a href="/c.pdf"></a></p><p><a href="a.pdf?x=1">Result again</a></p></section><footer><a href="/d.pdf">Footer notice</a></footer></body></html>"""


def pages(spark, text, feed="f"):
    return spark.createDataFrame([(feed, "b", "https://X.org/dir/", text)], "feed string, body string, url string, html string")


def read(spark, text, recipe):
    return listings.read_all(pages(spark, text), {"f": recipe}).collect()


def test_links(spark):
    got = {r.url: r for r in read(spark, PAGE, Recipe("html_links"))}
    assert {u: r.title for u, r in got.items()} == {"https://x.org/dir/a.pdf?x=1": "Result of CGL", "https://x.org/dir/b.pdf": "Schedule of tests Read More", "https://x.org/c.pdf": "c"}
    first = got["https://x.org/dir/a.pdf?x=1"]
    assert str(first.published) == "2025-02-05" and first.doc_type == "result" and len(first.id) == 64


def test_a_menu_that_holds_the_documents_is_content(spark):
    text = "<nav>" + "".join(f'<li><a href="{i}.pdf">Notice {i}</a></li>' for i in range(5)) + '</nav><p><a href="z.pdf">Other notice</a></p>'
    assert len(read(spark, text, Recipe("html_links"))) == 6


def test_scoped_items_and_excludes(spark):
    text = '<div class="row"><span class="d">1 May 2025</span><a href="x">Anything</a></div><div class="row"><a href="y">Skip me</a></div><a href="z.pdf">outside</a>'
    got = read(spark, text, Recipe("html_links", item="div.row", date=".d", exclude="(?i)skip"))
    assert [(r.title, str(r.published)) for r in got] == [("Anything", "2025-05-01")]


def test_table_rows(spark):
    text = '<table><tr><th>No</th><th>Title</th><th>Date</th></tr><tr><td>1</td><td>Advertisement for the post of clerk</td><td>03.04.2025</td><td><a href="n.pdf">View</a></td></tr></table>'
    (r,) = read(spark, text, Recipe("html_table"))
    assert (r.title, str(r.published), r.doc_type) == ("Advertisement for the post of clerk", "2025-04-03", "notification")


def test_options_feed_json_and_document(spark):
    text = '<table><tr><td>1</td><td>07/2025</td><td>Clerk</td><td>Result</td><td>01.02.2025</td><td><select><option value="/f.pdf">Hindi</option><option value=" "></option></select></td></tr></table>'
    (r,) = read(spark, text, Recipe("option_table"))
    assert r.title == "(07/2025) Clerk: Result (01.02.2025) [Hindi]" and str(r.published) == "2025-02-01"
    rss = '<rss><channel><item><title>Exam notice</title><link>https://x.org/1</link><pubDate>Mon, 03 Feb 2025 10:00</pubDate></item></channel></rss>'
    (r,) = read(spark, rss, Recipe("rss"))
    assert (r.title, str(r.published)) == ("Exam notice", "2025-02-03")
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Result</title><link href="https://x.org/2"/><updated>2025-01-02</updated></entry></feed>'
    assert [x.url for x in read(spark, atom, Recipe("rss"))] == ["https://x.org/2"]
    js = '{"data": {"rows": [{"title": "Parent", "no": 7, "files": [{"title": "Exam result", "path": "a\\\\\\\\b.pdf"}]}]}}'
    (r,) = read(spark, js, Recipe("json_api", items_path="data.rows", children_path="files", fields={"title": "title", "url": "path", "no": "no"}, url_template="https://x.org/{no}/{url}"))
    assert (r.title, r.url) == ("Exam result", "https://x.org/7/a/b.pdf")
    (r,) = listings.read_all(pages(spark, "%PDF"), {"f": Recipe("pdf_document", include=".")}).collect()
    assert r.url == "https://x.org/dir/"


def test_selectors():
    root = html.parse('<div class="a b" id="x"><p><a href="1.pdf">t</a></p></div><a href="2">u</a>')
    texts = lambda s: [e.text() for e in html.select(root, s)]
    assert texts("div.a p a[href$=.pdf]") == ["t"] and texts("#x a, body a") == ["t"] and texts("a[href]") == ["t", "u"]
    with pytest.raises(ValueError):
        html.select(root, "a:hover")


def test_page_view(spark):
    r = listings.page_view(pages(spark, PAGE), "feed", "html").first()
    assert r.title == "Board" and "Footer" not in r.text and r.unrendered and r.links == 9
    c = spark.createDataFrame([(bytearray(b"%PDF-1.4"), "text/html"), (bytearray(b"<html>"), "text/html"), (bytearray(b"\xff\xd8\xff"), "")], "c binary, t string")
    assert [x[0] for x in c.select(listings.routed(F.col("c"), F.col("t"))).collect()] == ["pdf", "html", "image"]


def test_files(spark, tmp_path):
    (tmp_path / "a.toml").write_text('[[exams]]\nid = "x"\nname = "X"\n[[exams]]\nid = "x"\n[[bodies]]\nid = "b"\n')
    assert sorted((r.kind, r.id) for r in files.toml_entities(spark, f"{tmp_path}/a.toml").collect()) == [("bodies", "b"), ("exams", "x"), ("exams", "x")]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "good.md").write_text('+++\ntitle = "T"\n[dates]\nfrom = "2026-01-01"\nto = "x"\n+++\nBody')
    (tmp_path / "r" / "bad.md").write_text("+++\nno end")
    rows = {r.slug: r for r in files.front_matter(spark, f"{tmp_path}/r/*.md").collect()}
    assert rows["bad"].error and rows["good"].body == "Body"
    flat = files.flatten(spark.createDataFrame([("good", rows["good"].json)], "slug string, json string"), "slug", "json")
    assert {r.path: r.value for r in flat.collect()} == {"title": "T", "dates": "2026-01-01 / x"}
    (tmp_path / "l.jsonl").write_text('# c\n{"id": "a b"}\n\n{"id": "c"}\n')
    assert [r.id for r in files.jsonl(spark, f"{tmp_path}/l.jsonl", "id string", comments=True).collect()] == ["a b", "c"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 1)], "id string, n int")
    assert [r.value for r in sinks.json_lines(df, "id").collect()] == ['{"id":"a","n":1}', '{"id":"b"}']
    sinks.write_json_lines(df, "id", f"{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"id":"a","n":1}', '{"id":"b"}']
    rows = spark.createDataFrame([("i", "u?a&b", "<T>", "e", "2026")], "id string, url string, title string, entity string, first_seen string")
    assert "&lt;T&gt;" in sinks.atom(rows, "Feed", "urn:x") and 'href="u?a&amp;b"' in sinks.atom(rows, "Feed", "urn:x")
    assert sinks.toml({"a": "x", "l": [1, 2], "t": {"b": "q\"r"}, "rows": [{"c": 1}]}) == 'a = "x"\nl = [1, 2]\n\n[t]\nb = "q\\"r"\n\n[[rows]]\nc = 1'
    with pytest.raises(TypeError):
        sinks.toml({"a": True})
    bad = sinks.add_checked(df, df, lambda x: x.groupBy("id").count().filter("count > 1"), f"{tmp_path}/t")
    assert bad.count() == 2 and not (tmp_path / "t").exists()
    assert "| all | 2 |" in sinks.counts_table(df, {"all": "count(*)"})

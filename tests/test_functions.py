from pyspark.sql import functions as F

from ledgerline.functions import dates, text, urls, values


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_identity_of_addresses(spark):
    lit = F.lit
    r = one(
        spark,
        plain=urls.canonical(lit("HTTPS://Example.ORG:443?b=2&a=1#top")),
        port=urls.canonical(lit("http://example.org:8080/x")),
        signed=urls.canonical(lit("https://s3.example.org/a.pdf?X-Amz-Signature=ab&X-Amz-Date=1&id=7")),
        unsigned=urls.canonical(lit("https://example.org/p?sp=2&id=7")),
        cache=urls.cache_key(lit("https://example.org/p?z=1&utm_source=x&a=2")),
        domain=urls.domain(lit("exams.nta.ac.in")), two=urls.domain(lit("www.example.org")),
        deeper=urls.deeper(lit("https://www.x.org/a/b"), lit("http://x.org/a/")), not_deeper=urls.deeper(lit("https://x.org/ab"), lit("https://x.org/a")),
    )
    assert r.plain == "https://example.org/?b=2&a=1" and r.port == "http://example.org:8080/x"
    assert r.signed == "https://s3.example.org/a.pdf?id=7" and r.unsigned == "https://example.org/p?sp=2&id=7"
    assert r.cache == "https://example.org/p?a=2&z=1"
    assert (r.domain, r.two, r.deeper, r.not_deeper) == ("nta.ac.in", "example.org", True, False)


def test_one_id_for_signed_addresses(spark):
    a, b = ("https://h.org/n.pdf?sig=%s&se=2030" % s for s in ("x", "y"))
    r = one(spark, a=urls.notice_id(F.lit(a)), b=urls.notice_id(F.lit(b)), c=urls.notice_id(F.lit(a), F.lit("t")))
    assert r.a == r.b != r.c and len(r.c) == 64


def test_days_are_never_guessed(spark):
    cases = {"Published 05/02/2025": "2025-02-05", "2024-03-15": "2024-03-15", "12th March, 2026": "2026-03-12", "Mar 3, 2026": "2026-03-03", "31-02-2026": None, "March 2026": None, "": None, "1.2.26": "2026-02-01", "2024-13-01 or 4.5.2024": "2024-05-04"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", dates.parse_day_first(F.col("t")).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in rows} == cases


def test_stamped_days(spark):
    today = F.lit("2026-01-01").cast("date")
    cases = [("05-02-2025 - Result of posts", "x.pdf"), ("Result dated 15.03.2023", "x.pdf"), ("Result", "Notice25Sep2024a.pdf"), ("Result", "Exam-Date-21-08-2016.pdf"), ("Dated 01.01.2030", "a.pdf")]
    rows = spark.createDataFrame(cases, "t string, f string").select(dates.stamped(F.col("t"), F.col("f"), today).alias("s")).collect()
    assert [(str(r.s.day), r.s["from"]) for r in rows] == [("2025-02-05", "title"), ("2023-03-15", "title"), ("2024-09-25", "url"), ("None", None), ("None", None)]


def test_cycles(spark):
    cases = {"Exam 2026-27": "2026", "Session December 2026": "2026-dec", "Examination, 2025 (as on 06.03.2026)": "2025", "as on 06.03.2026": "2026", "No year": None, "Exam 2024 and 2025": "2025"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", dates.cycle_label(F.col("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == cases
    r = one(spark, a=dates.cycle_key(F.lit("2026-mar")), b=dates.cycle_key(F.lit(None).cast("string")), w=F.array(*[dates.wait_days(F.lit(n)) for n in (0, 1, 2, 3, 4, 5)]), y=F.array(*[dates.expand_year(F.lit(t), 2026) for t in ("24", "25", "99", "1999")]))
    assert tuple(r.a) == (2026, 3) and tuple(r.b) == (0, 0) and r.w == [7, 7, 14, 28, 56, 90] and r.y == [2124, 2025, 2099, 1999]


def test_titles(spark):
    r = one(spark, a=text.clean_title(F.lit("  Result \n of  CGL (1.5 MB) | ")), b=text.clean_title(F.lit("Click here New! Notice –")), c=text.clip(F.lit("one two three four"), 9), s=text.slug(F.lit(" A b--C ")))
    assert (r.a, r.b, r.c, r.s) == ("Result of CGL", "! Notice", "one two", "a-b-c")


def test_scores_of_words(spark):
    cases = [("next", "the next exam", 1), ("nex", "the nextexam", 2), ("ups", "x upsc", 2), ("upsk", "x upsc", 4), ("zz", "x upsc", -1), ("exman", "exam board", 4), ("qqqq", "exam board", -1)]
    for term, hay, want in cases:
        assert one(spark, s=text.query_score(F.lit(hay), term)).s == want, term
    assert one(spark, s=text.query_score(F.lit("green box"), "zzzzz, box")).s == 1
    assert text.query_terms("a, b;a -c-") == ["a", "b", "c"]


def test_numbers(spark):
    r = one(
        spark, g=values.grouped_int(F.lit("1,04,233")), n=values.grouped_int(F.lit("12 posts")), c=F.array(*[values.cell_int(F.lit(t)) for t in ("276*", "12 (3)", "x")]),
        f=F.array(*[values.fee_cell(F.lit(t)) for t in ("Nil", "Rs. 1,000/-", "500", "99999")]), same=values.same_value(F.lit("5 June 2026 10"), F.lit("05/2026/10")), other=values.same_value(F.lit("a"), F.lit("b")),
        m=values.margin(F.array(F.lit(0.2), F.lit(0.7), F.lit(0.1))), ok=values.adds_up(F.lit(3).cast("long"), F.create_map(F.lit("a"), F.lit(1).cast("long"), F.lit("b"), F.lit(2).cast("long"))),
    )
    assert r.g == 104233 and r.n is None and r.c == [276, 12, None] and r.f == [0, 1000, 500, None]
    assert r.same and not r.other and abs(r.m - 0.5) < 1e-12 and r.ok

from pyspark.sql import functions as F

from ledgerline.operators import discovery, filters, links, naming, prose


def test_facts_in_sentences(spark):
    text = "Age limit\nMinimum age 18 years\nNot more than 40 years of age\nRelaxation of 5 years in age for OBC\nAge of children below 25 years\nPassed 12th or a B.Sc degree"
    rows = prose.clause_rows(spark.createDataFrame([(1, text)], "id long, t string"), "id", "t")
    assert [(r.age_min, r.age_max) for r in prose.ages(rows).orderBy("at").collect()] == [(18, None), (None, 40)]
    assert [(r.years, r.categories) for r in prose.relaxations(rows).collect()] == [(5, ["OBC"])]
    r = spark.range(1).select(
        prose.levels(F.lit(text)).alias("levels"), prose.stages(F.lit("Interview after a written test, then medical examination")).alias("stages"),
        prose.pay(F.lit("Pay Level 6 (Rs. 35,400 - 1,12,400)")).alias("pay"), prose.pay(F.lit("Rs. 100 - 200")).alias("none"), prose.advert(F.lit("Advt. No. 12/2026-R.")).alias("advert"),
        prose.links(F.lit("see www.x.org/apply, http://x.org/a. or a@www.b.org/ccc")).alias("links"),
    ).first()
    assert r.levels == ["Graduate", "Class 12"] and r.stages == ["Interview", "Written examination", "Medical examination"]
    assert tuple(r.pay) == (6, 35400, 112400) and tuple(r.none) == (None, None, None) and r.advert == "12/2026-R"
    assert r.links[:2] == ["https://www.x.org/apply", "http://x.org/a"]


def test_link_states(spark):
    cases = [(200, "https://x.org/a", "https://www.x.org/b", "ok"), (200, "https://x.org/a", "https://y.org/", "redirected"), (403, "u", "u", "blocked"), (410, "u", "u", "not_found"), (500, "u", "u", "error"), (200, "https://x.org", "https://x.org/404", "soft_404")]
    df = spark.createDataFrame(cases, "s int, u string, f string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", links.verified(F.col("s"), F.col("u"), F.col("f"), F.lit(""))).collect())
    df = spark.createDataFrame([("p", "Apply 2024", "a"), ("p", "Apply online", "b"), ("p", "Apply 2026", "c")], "p string, t string, u string")
    assert [r.u for r in links.apply_links(df, "p", "t", "u").orderBy("place").collect()] == ["b", "c", "a"]
    parents = spark.createDataFrame([("P", "List", None)], "url string, title string, published date")
    kids = spark.createDataFrame([("P", "Part", None), ("P", "List", None)], "parent_url string, title string, published date")
    assert sorted(r.title for r in links.with_parent(parents, kids).collect()) == ["List", "List - Part"]
    found = spark.createDataFrame([("b", f"https://x.org/notices/{i}", "Notices") for i in range(12)] + [("b", "https://x.org/tender", "Tender notices")], "body string, url string, text string")
    known = spark.createDataFrame([("http://www.x.org/notices/3/",)], "url string")
    assert links.page_trials(found, "body", "(?i)notice", "(?i)tender", known).count() == 8


def test_filters(spark):
    today = F.lit("2026-03-01").cast("date")
    urls = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4), ("d", 5)], "url string, place int")
    done = spark.createDataFrame([("b", "s", None, 0), ("c", None, "2026-02-25", 1), ("d", None, "2026-02-01", 2)], "url string, snapshot string, tried string, failures int")
    assert sorted((r.url, r.place) for r in filters.to_archive(urls, done, today).collect()) == [("a", 1), ("d", 5)]
    claims = spark.createDataFrame([("c", "exam_date", "x", 0.5), ("c", "deadline", "x", 0.9), ("c", "exam_date", "y", 0.5)], "clause string, field string, value string, hint double")
    assert sorted((r.field, r.value) for r in filters.drop_weak(claims, ["clause"], "field", "value", "hint").collect()) == [("deadline", "x"), ("exam_date", "y")]
    facts = spark.createDataFrame([("r", "1"), ("r", "unknown"), ("r", None)], "record string, value string")
    assert filters.known_facts(facts, "record", "value").first().known == 1
    r = spark.range(1).select(filters.plausible(F.lit(2026), F.lit(2025), target=F.lit("unknown")).alias("a"), filters.plausible(F.lit(2029), F.lit(2025), target=F.lit(None)).alias("b"), filters.plausible(F.lit(2025), F.lit(2025), target=F.lit("2025-01-01")).alias("c")).first()
    assert (r.a, r.b, r.c) == (True, False, False)


def test_names(spark):
    assert naming.series("Notification for the National Eligibility Examination 2026") == [("National Eligibility", "examination")]
    assert naming.series("UGCNET 2026 result") == [("UGCNET", "acronym")] and naming.series("Online Examination") == []
    assert ("Junior Engineer", "recruitment") in naming.series("Recruitment to the post of Junior Engineer in the works department")
    r = spark.range(1).select(
        naming.heading(F.lit("text here\n5. FEE DETAILS\nbody")).alias("a"), naming.heading(F.lit("x\nIMPORTANT DATES\nbody")).alias("b"), naming.heading(F.lit("nothing at all")).alias("c"),
        naming.file_date_hint(F.lit("n-15-03-2027.pdf"), F.lit("")).alias("d"), naming.file_date_hint(F.lit("n2026.pdf"), F.lit("")).alias("e"), naming.file_date_hint(F.lit("n.pdf"), F.lit("Exam 2025")).alias("f"), naming.file_date_hint(F.lit("n.pdf"), F.lit("")).alias("g"),
        naming.scan_language(F.lit("ta"), {"ta": "tam"}).alias("h"),
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h) == ("5. FEE DETAILS", "IMPORTANT DATES", None, "2027-03-15", "2026", "Exam 2025"[-4:], None, "tam+eng")


def test_discovery(spark):
    df = spark.createDataFrame([("b", "x", "2025"), ("b", "x", "2026"), ("b", "y", "2026"), ("c", "z", "2026")], "body string, name string, y string")
    got = {r.body: (r.name, r.score) for r in discovery.proposals(df, ["body"], "name", F.lit(False), F.col("y")).collect()}
    assert got == {"b": ("x", 5)}
    names = spark.createDataFrame([("1", "b", ["duet"]), ("2", "b", ["delhi", "university", "entrance", "test"]), ("3", "c", ["delhi", "university", "entrance", "test"])], "id string, body string, w array<string>")
    assert [(r.acronym, r.full) for r in discovery.acronyms(names, "id", "w", ["body"]).collect()] == [("1", "2")]

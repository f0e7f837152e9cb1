"""Own grids, pages, titles and days for the functions that read them."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates, values
from ledgerline.functions import text as tx
from ledgerline.operators import candidates, headers, merge, naming, ranking, tables, vocabulary
from ledgerline.sources import listings
from ledgerline.sources.html import parse, select


@pytest.mark.parametrize(
    ("header", "rows", "kind"),
    [
        (["Post", "UR", "SC", "ST", "Total"], [["Clerk", "4", "2", "1", "7"]], "vacancy"),
        (["Paper", "UR", "SC", "Fee payable"], [["I", "500", "250", ""]], "fee"),
        (["Category", "Application fee"], [["General", "Rs. 500"], ["SC", "Nil"]], "fee"),
        (["Post", "Pay scale", "Amount"], [["Clerk", "Level 4", "Rs. 25,500"]], "keyvalue"),
        (["Category", "Age relaxation"], [["OBC", "3 years"]], "relaxation"),
        (["Paper", "Questions", "Marks", "Duration"], [["I", "100", "200", "2 hours"]], "pattern"),
        (["Post", "No. of posts"], [["Clerk", "7"]], "vacancy"),
        (["Event", "Day"], [["Last date", "12.03.2026"], ["Result", "01.04.2026"]], "schedule"),
        (["Name", "Office"], [["A", "B"]], "keyvalue"),
        (["A", "B", "C", "D", "E"], [["a", "b", "c", "d", "e"]], None),
    ],
)
def test_kinds_of_tables(header, rows, kind):
    assert tables.kind(header, rows) == kind


def test_vacancies_of_a_grid():
    header = ["S. No", "Post", "UR", "SC", "ST", "PwBD out of total", "Total posts"]
    rows = [["1", "Clerk", "4", "2", "1", "1", "7"], ["", "Female", "1", "", "", "", ""], ["2", "Guard / Night", "3", "1*", "", "", ""], ["", "Grand Total", "8", "3", "1", "", "12"], ["", "none", "", "", "", "", ""]]
    got = tables.vacancies(header, rows)
    assert [(x["label"], x["total"], x["is_total"]) for x in got] == [("Clerk", 7, False), ("Clerk / Female", 1, False), ("Guard / Night", 4, False), ("Total", 12, True)]
    assert got[0]["by_category"] == {"Unreserved": 4, "SC": 2, "ST": 1, "PwBD": 1} and got[2]["by_category"] == {"Unreserved": 3, "SC": 1}


def test_columns_of_totals():
    assert tables._roles(["Total", "Posts"])[0] == 0 and tables._roles(["Posts", "Total vacancies"])[0] == 1
    assert tables._roles(["Post code", "Serial no"])[0] is None and tables._roles(["SC posts", "UR"]) == (None, {0: "SC", 1: "Unreserved"})


def test_days_as_they_are_written(spark):
    cases = {
        "on 2026-03-12 at noon": "2026-03-12", "12.03.2026": "2026-03-12", "5/4/26": "2026-04-05", "12th March, 2026": "2026-03-12", "12MAR2026": "2026-03-12", "Sept 3, 2026": "2026-09-03", "March 12th 2026": "2026-03-12",
        "31.02.2026 or 1 May 2026": "2026-05-01", "112.03.2026": None, "12.03.20261": None, "12 marks 2026": None, "maybe 12 2026": None, "12.03.1996": None, "": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", dates.parse_day_first(F.col("t")).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in rows} == cases


def test_own_day_of_a_notice(spark):
    cases = [
        ("12.03.2025 - Result of the test", "", "2025-03-12", "title"), ("Notice dated 5th May 2025 about posts", "", "2025-05-05", "title"), ("Examination on 1 June 2025", "", None, None),
        ("Notice", "advt_12-05-2025.pdf", "2025-05-12", "url"), ("Notice", "exam_12-05-2025.pdf", None, None), ("Notice", "n-12-05-25.pdf", None, None), ("12.03.2031 - Result", "", None, None),
    ]
    rows = spark.createDataFrame([c[:2] for c in cases], "t string, f string").select(dates.stamped(F.col("t"), F.col("f"), F.lit("2026-01-01").cast("date")).alias("s")).collect()
    assert [(r.s.day and str(r.s.day), r.s["from"]) for r in rows] == [c[2:] for c in cases]


def test_series_of_titles():
    assert naming.series("Admit card for the Combined Graduate Level Examination, 2026") == [("Combined Graduate Level", "examination")]
    assert naming.series("Results: Junior Clerk Entrance Test 2025 and State Police Recruitment") == [("Junior Clerk", "entrance test"), ("and State Police", "recruitment")]
    assert naming.series("ABCD-2026 notice") == [("ABCD", "acronym")] and naming.series("PDF 2026") == []
    assert naming.series("Filling of posts of Staff Nurse, Grade II under the board") == [("Staff Nurse", "recruitment")]
    assert naming.series("") == [] and naming.series("Final Online Examination") == []


def links(page, inside):
    root = parse(page)
    out = listings.outside_content(root, select(root, "a[href]"))
    return {a.attrs["href"] for a in select(root, "a[href]") if (id(a) in out) == inside}


def test_links_in_furniture():
    page = '<nav><a href="home"></a><div class="main-menu"><a href="n.pdf"></a></div></nav><div id="content"><a href="a.pdf"></a><a href="b.pdf"></a><p><a href="c"></a></p></div><footer><a href="z"></a></footer>'
    assert links(page, True) == {"home", "n.pdf", "z"} and links(page, False) == {"a.pdf", "b.pdf", "c"}
    kept = '<div class="Header_box"><ul><li><a href="a.pdf"></a><li><a href="b.pdf"></a></ul><select><a href="s"></a></select></div><a href="c.pdf"></a>'
    assert links(kept, True) == set()  # the header holds most documents of the page, so it is where they are listed
    assert links("<p>none</p>", True) == set()


def test_text_beside_a_link():
    beside = lambda page: listings._beside(select(parse(page), "a")[0])
    assert beside('<table><tr><td>Notice of the 12th <td><a href=x>View</a></tr></table>') == "Notice of the 12th View"
    assert beside(f'<div>{"word " * 200}<a href=x>View</a></div>') == "" and beside("<div><a href=x>View</a></div>") == ""


def test_nearness_is_one_table(spark):
    steps = [0, 25, 26, 60, 61, 120, 121]
    rows = spark.createDataFrame([(i,) for i in steps], "d int").select(values.proximity(F.col("d")).alias("p")).collect()
    assert [r.p for r in rows] == [0.1, 0.1, 0.05, 0.05, 0.0, 0.0, -0.1]
    assert candidates.NEAR is values.NEAR


def test_notices_of_another_cycle(spark):
    ints = lambda x: F.array(*[F.lit(i) for i in x]) if x else F.array().cast("array<int>")
    ask = lambda r, n: spark.range(1).select(ranking.other_cycle(ints(r), ints(n)).alias("x")).first().x
    assert [ask([2026], [2025]), ask([2026], [2026, 2020]), ask([2026], [2024]), ask([], [2024]), ask([2026], [])] == [False, False, True, False, False]
    score = lambda *a: spark.range(1).select(ranking.notice_score(*a).alias("x")).first().x
    day = lambda s: F.lit(s).cast("date")
    assert score(F.lit(0.5), F.lit("notification"), day("2026-01-01"), day("2026-03-01"), ints([2026]), ints([2026])) == 11.5
    assert score(F.lit(0.5), F.lit("nothing"), day("2020-01-01"), day("2026-03-01"), ints([2026]), ints([])) == 4.5
    cursors = spark.createDataFrame([("a", "2026-01-01"), ("b", "2026-01-02")], "site string, last string")
    done = spark.createDataFrame([("b",), ("c",)], "site string")
    assert {tuple(r) for r in ranking.moved_cursors(cursors, done, "site", F.lit("2026-02-01")).collect()} == {("a", "2026-01-01"), ("b", "2026-02-01"), ("c", "2026-02-01")}


def test_values_that_say_more(spark):
    less = lambda a, b: spark.range(1).select(merge.says_less(F.lit(a), F.lit(b)).alias("x")).first().x
    assert less("https://a.in/", "https://a.in/jobs") and less("https://a.in/jobs/", "https://a.in/jobs/x") and less("pen_paper", "omr")
    assert not less("https://a.in/jobs", "https://a.in/jobs/x") and not less("https://b.in/", "https://a.in/jobs") and not less("omr", "pen_paper") and not less("x", "y")


def test_heads_and_indic_dates(spark):
    rows = [["a", "1", "x", "2 (1)"], ["b", "2", "3", "-"]]
    df = spark.createDataFrame([(1, ["Name", "SEBC-A", "Zone", "MBC"], rows)], "id int, header array<string>, rows array<array<string>>")
    assert df.select(headers.unmapped(F.col("header"), F.col("rows")).alias("u")).first().u == ["SEBC-A", "Zone", "MBC"]
    got = spark.createDataFrame([("१२ मार्च २०२६",), ("plain 12",), ("अमार्च",)], "t string").select(tx.western_dates(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == ["12 March 2026", "plain 12", "अमार्च"]


def test_classes_by_place():
    table = {
        "class": [{"id": "x:OSC", "codes": ["OSC"], "jurisdictions": ["x"]}, {"id": "SC", "aliases": ["scheduled castes?"], "codes": ["SC"]}, {"id": "y:OSC", "codes": ["OSC"], "jurisdictions": ["y"]}],
        "alias": [{"to": "SC", "codes": ["DSC"], "jurisdictions": ["x"]}],
    }
    known = vocabulary.spellings(table)
    assert vocabulary.named("OSC, SC", known, "x") == ["x:OSC", "SC"] and vocabulary.named("OSC", known, "y") == ["y:OSC"] and vocabulary.named("OSC", known) == []
    assert vocabulary.named("B.Sc, sc, SC-A, SCX", known) == [] and vocabulary.named("DSC", known, "x") == ["SC"] and vocabulary.named("", known) == []
    assert vocabulary.problems(table) == [] and len(vocabulary.problems({"class": [{"id": "a", "codes": ["("]}, {"id": "a"}], "alias": [{"to": "b"}]})) == 3


def test_values_in_the_cells_below():
    got = {c["field"]: c for c in candidates.find("Post | Last date | Total vacancies | Application fee\nClerk | 12.03.2026 | 45 | Rs. 500\nGuard | 1.4.2026 | 3 | Nil")}
    assert {f: c["value"] for f, c in got.items()} == {"registration_deadline": "2026-03-12", "vacancies": "45", "fee": "500"}
    assert got["fee"]["hint"] == 0.6
    more = {c["field"]: c["value"] for c in candidates.find("Last date for payment of fee: 15.03.2026\nAge will be counted as on 01.01.2026. Admit cards are there up to 05.05.2026\nPay scale: Rs. 25,500\nVenue: Town hall, Pune\nEligibility: degree in law")}
    assert more["payment_deadline"] == "2026-03-15" and "registration_deadline" not in more and more["age_as_on"] == "2026-01-01" and more["admit_card_to"] == "2026-05-05"
    assert more["pay"] == "25500" and more["venue"] == "Town hall, Pune" and more["eligibility"] == "degree in law"

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.text import phrase_pattern
from ledgerline.operators import candidates, evaluation, lint, matching, merge, selection, state, survivorship, tables
from ledgerline.operators.matching import Rule


def test_longest_span_veto_and_ties(spark):
    rules = [Rule("cgl", (phrase_pattern("SSC CGL"),), group=2), Rule("ssc", (phrase_pattern("SSC"),), group=2), Rule("twin", (phrase_pattern("ssc cgl"),), (r"(?i)tier",), group=2), Rule("other", (phrase_pattern("SSC"),), scope=("b2",), group=2)]
    titles = ["SSC-CGL 2026", "ssc_cgl tier 1", "SSC notice", "SSCX", "nothing"]
    df = spark.createDataFrame([(t, "b1") for t in titles], "t string, b string")
    got = {r.t: r.hits for r in matching.match(df, F.col("t"), rules, F.col("b")).collect()}
    assert got == {"SSC-CGL 2026": ["cgl", "twin"], "ssc_cgl tier 1": ["cgl"], "SSC notice": ["ssc"], "SSCX": [], "nothing": []}


def now():
    return F.lit("2026-01-02").cast("date")


def snapshots(spark):
    old = spark.sql("SELECT * FROM VALUES ('a', 'f', 'x', DATE '2026-01-01', CAST(NULL AS DATE)), ('b', 'f', 'x', DATE '2026-01-01', DATE '2026-01-01'), ('c', 'f', 'x', DATE '2026-01-01', NULL), ('d', 'down', 'x', DATE '2026-01-01', NULL) AS t(id, feed, published, first_seen, gone_since)")
    fresh = spark.sql("SELECT * FROM VALUES ('a', 'f', CAST(NULL AS STRING)), ('b', 'f', 'y'), ('n', 'f', 'z') AS t(id, feed, published)")
    return old, fresh, spark.createDataFrame([("f",)], "feed string")


def test_snapshot_merge(spark):
    merged = state.snapshot_merge(*snapshots(spark), now(), keep=("published",))
    got = {r.id: (r.published, str(r.first_seen), r.gone_since and str(r.gone_since), r.change) for r in merged.collect()}
    assert got == {"a": ("x", "2026-01-01", None, None), "b": ("y", "2026-01-01", None, "back"), "c": ("x", "2026-01-01", "2026-01-02", "gone"), "d": ("x", "2026-01-01", None, None), "n": ("z", "2026-01-02", None, "new")}
    assert [(r.id, r.change) for r in state.change_log(merged, now(), "entity").collect()] == [("n", "new"), ("b", "back"), ("c", "gone")]


def test_a_run_without_change_changes_nothing(spark):
    old, fresh, ran = snapshots(spark)
    once = state.snapshot_merge(old, fresh, ran, now(), keep=("published",)).drop("change")
    again = state.snapshot_merge(once, fresh, ran, F.lit("2026-03-03").cast("date"), keep=("published",))
    assert not again.filter("change IS NOT NULL").head(1)
    assert sorted(map(tuple, again.drop("change").collect()), key=str) == sorted(map(tuple, once.select(*again.drop("change").columns).collect()), key=str)


def test_tiers_ignore_the_first_day_and_the_future(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', DATE '2026-01-01', CAST(NULL AS DATE)), ('a', DATE '2026-01-01', NULL), ('b', DATE '2026-01-01', NULL), ('b', DATE '2026-03-01', NULL), ('c', DATE '2026-01-01', DATE '2030-01-01') AS t(feed, first_seen, published)")
    feeds = spark.createDataFrame([("a", None), ("b", None), ("c", None), ("d", "hot")], "feed string, pinned string")
    got = {r.feed: r.tier for r in state.tiers(rows, feeds, F.lit("2026-03-10").cast("date")).collect()}
    assert got == {"a": "cold", "b": "hot", "c": "cold", "d": "hot"}


def test_budget_takes_turns(spark):
    rows = [(i, g, h, f) for i, (g, h, f) in enumerate([("a", "h1", 1), ("a", "h1", 1), ("a", "h1", 1), ("b", "h2", 0), ("b", "h3", 0), ("c", "h4", 0), ("a", "h1", 0)])]
    df = spark.createDataFrame(rows, "id long, g string, h string, fresh long")
    got = selection.budget(df, group="g", host="h", order=[F.col("id")], priority=[F.col("g")], fresh=F.col("fresh") == 1, limit=10).orderBy("place")
    assert [r.id for r in got.collect()] == [0, 1, 2, 3, 5, 4]


def test_keep_first_never_drops_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id long, k string")
    assert sorted(r.id for r in selection.keep_first(df, ["k"], [F.col("id")]).collect()) == [1, 3, 4]


def test_fees_are_not_carried_over(spark):
    df = spark.createDataFrame([("e", 2025, "fee", 1), ("e", 2025, "pay", 2), ("e", 2026, "pay", None), ("e", 2026, "x", 3)], "exam string, cycle int, field string, value int")
    got = {r.field: (r.value, r.carried_from) for r in survivorship.carried(df, "exam", "field", "cycle", "value", [F.col("value")], ("fee",)).collect()}
    assert got == {"pay": (2, 2025), "x": (3, None)}


def test_month_is_never_a_value(spark):
    df = spark.createDataFrame([("d", "month", 0.9, 1, "June 2026"), ("d", "day", 0.5, 2, "2026-06-01"), ("m", "month", 0.9, 1, "June 2026")], "field string, granularity string, hint double, page int, value string")
    got = {r.field: (r.value, r.rejected, r.notes) for r in survivorship.adjudicate(df, ["field"], granularity="granularity", hint="hint", page="page", value="value", tie=[F.col("value")]).collect()}
    assert got == {"d": ("2026-06-01", 0, 1), "m": (None, 0, 1)}


def test_merge_and_diff(spark):
    facts = spark.createDataFrame([("g", "a", "unknown"), ("g", "a", "1"), ("g", "b", "x"), ("g", "b", "y"), ("g", "c", "")], "record string, path string, value string")
    got = {r.path: (r.value, r.conflict) for r in merge.merge_facts(facts, "record").collect()}
    assert got == {"a": ("1", False), "b": (None, True), "c": ("", False)}
    after = spark.createDataFrame([("g", "a", "2"), ("g", "n", "1"), ("g", "s", "open:2"), ("g", "provenance.x", "2")], "record string, path string, value string")
    before = spark.createDataFrame([("g", "a", "1"), ("g", "b", "1"), ("g", "s", "open:1"), ("g", "provenance.x", "1")], "record string, path string, value string")
    d = merge.diff(before, after, ["record", "path"], "value", bookkeeping=("provenance",))
    assert {r.path: r.kind for r in d.collect()} == {"a": "changed", "b": "removed", "n": "added", "s": "status-change", "provenance.x": "changed"}
    assert merge.material(d, "record").first().changes == 4


def test_papers_and_families(spark):
    rows = [(1, "national entrance test"), (2, "national entrance test ug"), (3, "national entrance test pg"), (4, "national entrance test english paper"), (5, "another test")]
    df = spark.createDataFrame(rows, "id long, t string").select("id", F.lit("b").alias("body"), merge.name_words(F.col("t")).alias("w"))
    assert [(r.family, r.parts) for r in merge.families(df, "id", "w", ["body"], ("ug", "pg", "exam")).collect()] == [(1, [2, 3])]
    assert [(r.exam, r.papers) for r in merge.papers(df, "id", "w", ["body"]).collect()] == [(1, [4])]


def test_lint(spark):
    child = spark.createDataFrame([("x", ["a", "q"]), ("x", ["a"]), ("", None)], "id string, refs array<string>")
    parent = spark.createDataFrame([("a",)], "k string")
    found = lint.together(lint.references(child, "id", "refs", parent, "k", "ref"), lint.doubled(child, "id", "twice"), lint.required(child, "id", ["id", "refs"], "needs"))
    assert sorted(map(tuple, found.collect())) == [("needs", "", "id"), ("needs", "", "refs"), ("ref", "x", "q"), ("twice", "x", "2")]
    facts = spark.createDataFrame([("r", "a", "text"), ("r", "z", "text")], "record string, path string, kind string")
    shape = spark.createDataFrame([("a", "list", False), ("b", "text", True)], "path string, kind string, required boolean")
    assert sorted(map(tuple, lint.check_shape(facts, lint.shape(shape)).collect())) == [("r", "a", "wrong kind"), ("r", "b", "missing"), ("r", "z", "unknown key")]


@pytest.mark.parametrize(("scores", "want"), [([(0.1, False), (0.9, True)], 1.0), ([(0.5, False), (0.5, True)], 0.5), ([(0.9, False), (0.1, True)], 0.0), ([(0.9, True)], None)])
def test_auc(spark, scores, want):
    assert evaluation.auc(spark.createDataFrame(scores, "p double, y boolean"), "p", "y").first().auc == want


def test_top_bin_is_closed(spark):
    rows = evaluation.calibration(spark.createDataFrame([(1.0, True), (0.8, False)], "p double, y boolean"), "p", "y").collect()
    assert [(r.bin, r.n) for r in rows] == [(4, 2)]


def test_vacancy_table():
    grid = [["Statement of posts", "", "", "", ""], ["Name of post", "Category", "", "", "Total"], ["", "UR", "SC", "Out of which PwBD", ""], ["Clerk", "10", "5*", "1", "15"], ["Male", "4", "2", "0", "6"], ["", "", "", "", ""], ["Total", "14", "7", "1", "21"]]
    header, rows = tables.split_header(tables.tidy(grid))
    assert header == ["Name of post", "Category UR", "Category SC", "Category Out of which PwBD", "Total"]
    assert tables.kind(header, rows) == "vacancy"
    got = tables.vacancies(header, rows)
    assert [(r["label"], r["total"], r["is_total"]) for r in got] == [("Clerk", 15, False), ("Clerk / Male", 6, False), ("Total", 21, True)]
    assert got[0]["by_category"]["SC"] == 5


def test_other_tables(spark):
    assert tables.fees(["Category", "Fee", "Late fee"], [["SC / ST", "Nil", "500"], ["All except SC", "Rs. 1,000", "1500"], ["GST", "18%", ""]]) == [{"categories": ["SC", "ST"], "except": False, "amount": 0, "for": ""}, {"categories": ["SC"], "except": True, "amount": 1000, "for": ""}]
    assert tables.kind(["Pay level", "Pay scale"], [["4", "Rs. 25,500"]]) != "fee"
    assert tables.relaxations([], [["OBC", "3 years"], ["ESM", "5 (five) years"]])[1] == {"categories": ["ESM"], "for": "ESM", "years": 5}
    assert tables.patterns(["Paper", "Questions", "Marks", "Duration"], [["Maths", "50", "100", "2 hours"]]) == [{"paper": "Maths", "questions": 50, "marks": 100, "duration": "2 hours"}]
    lines = "Opening of\nonline application\n07 March 2026\nLast date | 31.03.2026 to 05.04.2026\nResult to be announced\nExam\n31.02.2026"
    assert [(x["key"], x["date"], x["until"]) for x in tables.schedule_lines(lines)] == [("registration_open", "2026-03-07", None), ("registration_deadline", "2026-03-31", "2026-04-05")]
    assert tables.spans("other backward class sc", {"a": "backward class", "b": "class", "c": "sc"}) == [(6, 20, "a"), (21, 23, "c")]
    assert tables.islands([1, 2, None, 3]) == [(0, 2), (3, 4)] and tables.sum_cell([4, 6, 10, 1]) == 2 and tables.sum_cell([1, 2, 3]) is None
    rows = tables.structure(spark.createDataFrame([(1, json.dumps([["a", "b"]])), (2, "no json"), (3, None)], "id long, g string"), "id", "g").collect()
    assert {r.id: r.kind for r in rows} == {1: None, 2: "failed", 3: None}


def test_candidates():
    text = "Notice dated 01.01.2026\nLast date to apply: 15 March 2026. Application fee Rs. 500/-; Total vacancies: 1,204\nWritten exam on June 2026\nAdmit card\n1 May 2026 (tentative)"
    got = {c["field"]: c for c in candidates.find(text)}
    assert got["registration_deadline"]["value"] == "2026-03-15" and not got["registration_deadline"]["provisional"]
    assert got["fee"]["value"] == "500" and got["vacancies"]["value"] == "1204"
    assert got["exam_date"]["granularity"] == "month"
    assert got["admit_card"]["value"] == "2026-05-01" and got["admit_card"]["provisional"]
    many = candidates.find("Exam date 1.1.2026 or 2.1.2026 or 3.1.2026")
    assert many[0]["ambiguous"]
    assert candidates.unwrapped("x" * 60 + " and\nmore of it") == "x" * 60 + " and more of it"

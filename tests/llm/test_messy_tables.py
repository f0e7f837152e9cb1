"""Every query over tables with nulls, empty and long texts, repeated rows and columns of clashing names, and over
empty tables."""

import pytest

import corpus_pipeline
from ledgerline.llm import queries as q

from .conftest import LONG, ROWS

WHOLE = [n for n in q.queries() if n.split("_")[0] in ("op1", "op3", "op4", "op5", "op7", "op8", "op10")]


@pytest.mark.parametrize("name", list(q.queries()))
def test_empty_tables(spark, nothing, name):
    assert q.queries()[name](spark, nothing).collect() == []


@pytest.mark.parametrize("name", WHOLE)
def test_a_row_for_each_document(spark, messy, name):
    rows = q.queries()[name](spark, messy).collect()
    ids = lambda x: sorted((r[0] is None, r[0] or 0) for r in x)
    assert ids(rows) == ids(ROWS)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_scores_empty_texts(spark, messy):
    r = by_id(q.queries()["op1_ftrl_quality"](spark, messy))
    assert r[2].score == r[3].score == r[4].score and 0 <= r[2].score <= 1


def test_language_of_texts_without_letters(spark, messy):
    r = by_id(q.queries()["op7_language_id"](spark, messy))
    assert [(r[i].lang_pred, r[i].score) for i in (2, 3, 4, 8)] == [("und", 0.0)] * 4


def test_rule_measures(spark, messy):
    r = by_id(q.queries()["op5_rule_cascade"](spark, messy))
    assert (r[2].n_words, r[2].base_failed, r[2].kept) == (0, True, False)
    assert (r[6].n_words, r[6].word_chars) == (40_000, len(LONG) - 39_999)


def test_mix_of_sizes(spark, messy):
    rows = q.queries()["op3_pareto_mixing"](spark, messy).collect()
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert all(r.taken <= 3 * r.size and r.target <= 3 * r.source_size + 1e-9 for r in rows)


def test_simhash_groups(spark, messy):
    rows = q.queries()["op8_simhash_neardup"](spark, messy).collect()
    r = {x.doc_id: x for x in rows}
    assert r[2].fingerprint == r[3].fingerprint == "0" * 16 and {r[i].component_id for i in (2, 3, 4)} == {2}
    assert r[10].component_id == 1 and r[None].component_id is None


def test_decontamination_finds_the_item(spark, messy):
    assert [(r.doc_id, r.item_id, r.containment) for r in q.queries()["op2_benchmark_decontam"](spark, messy).collect()] == [(7, 1, 1.0)]


def test_license_found(spark, messy):
    assert [(r.doc_id, r.license) for r in q.queries()["op9_license_scan"](spark, messy).collect()] == [(11, "MIT")]


def test_pages(spark, messy):
    rows = q.queries()["op6_dom_extraction"](spark, messy).collect()
    assert len(rows) == 6
    r = {x.page_id: x for x in rows}
    assert r[1].text == "Main text & more, and bold." and r[1].n_chars == len(r[1].text)
    assert r[2].text == r[3].text == "" and r[2].n_chars == 0


def test_pipeline(spark, messy, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, messy)
        if name != "sharding":
            assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        if name == "language_id":
            assert {r.doc_id for r in docs.collect()}.isdisjoint({2, 3, 4, 8})
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.collect()]
            assert ids.count(5) == 1 and 10 not in ids
        if name == "decontamination":
            assert 7 not in {r.doc_id for r in docs.collect()}
    slots = sorted((r.shard, r.slot) for r in docs.collect())
    assert len(slots) == len(set(slots)) and "score" in docs.columns

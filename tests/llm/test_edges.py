"""Every training-data operator and pipeline stage on awkward rows: nulls, empty and long texts, ties, repeated rows,
empty tables, and columns whose names clash with those the operators make."""

from __future__ import annotations

import pytest

import corpus_pipeline
from outcome_lens.llm import (
    contamination, main_text, mixing, near_duplicates, perplexity, personal_data, token_ids, toxicity, url_rules, warc,
)
from outcome_lens.llm.queries import byte_bpe
from outcome_lens.session import new_path

CLASHES = "row string, node string, size long, taken long, found string, score double, content string, source_size long, held_out string, rounds long, n_words string, bands string, class_id long, part long, start long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
PAGES = "page_id long, url string, html string, digest string, first long, host string, rule string, pattern string, text string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
PLAIN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *([None] * 15))


ROWS = [
    row(1, PLAIN), row(1, PLAIN), row(2, PLAIN), row(1, "the same id with another text"), row(3, ""), row(4, None), row(None, PLAIN),
    row(5, LONG), row(6, "Ünï \U0001f600 ñandú  ...\n\n", None, None), row(7, " \n\t", "fr", None), row(8, "one", None, "b"), row(None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PLAIN, "x"), (1, PLAIN, "x"), (None, "word1 and1", None), (2, None, None), (3, "", None)]
    return spark.createDataFrame(rows, "item_id long, text string, found string")


def ids(df):
    return sorted((r.doc_id is None, r.doc_id) for r in df.collect())


ALL = sorted((r[0] is None, r[0]) for r in ROWS)


def test_personal_data(docs, none):
    out = personal_data.personal_data(docs)
    assert ids(out) == ALL and {r.spans for r in out.collect()} == {""}
    assert personal_data.personal_data(none).count() == 0


def test_toxicity(docs, none, spark):
    out = toxicity.toxicity(docs, toxicity.START)
    assert ids(out) == ALL and all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.toxicity(none, toxicity.START).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels) == toxicity.START  # one label alone teaches nothing
    assert toxicity.learn(none, labels.limit(0)) == toxicity.START


def test_near_duplicates(docs, none):
    out = near_duplicates.near_duplicates(docs).collect()
    assert len(out) == len(ROWS)
    classes = {(r.doc_id, r.class_id) for r in out}
    assert {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (None, 3), (5, 5)} <= classes
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 3, 5, 6, 7, 8]
    assert near_duplicates.near_duplicates(none).count() == 0 and near_duplicates.one_of_each(none).count() == 0


def test_contamination(docs, none, items):
    out = {(r.doc_id, r.n_words): r for r in contamination.contamination(docs, items).collect()}
    assert out[1, 14].contaminated and out[1, 14].n_hit == 14 and out[1, 14].n_items == 1
    assert out[4, 0].n_hit == 0 and not out[4, 0].contaminated
    assert out[5, 80_000].n_items == 0 and out[5, 80_000].n_hit > 0  # an item without an id hits, and is not listed
    kept = contamination.decontaminated(docs, items)
    assert kept.columns == docs.columns and PLAIN not in {r.text for r in kept.collect()}
    assert contamination.contamination(none, items).count() == 0
    assert {r.n_hit for r in contamination.contamination(docs, items.limit(0)).collect()} == {0}


def test_token_ids(docs, none, spark):
    folder = new_path(spark, "edges")
    token_ids.write_token_ids(docs, folder, byte_bpe())
    out = token_ids.document_positions(spark, folder).collect()
    assert len(out) == len(ROWS)
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.n_tokens for r in out if r.doc_id in (3, 4)] == [1, 1]
    folder = new_path(spark, "edges")
    token_ids.write_token_ids(none, folder, byte_bpe())
    assert token_ids.document_positions(spark, folder).count() == 0


def test_mixing(docs, none):
    out = mixing.mixture(docs)
    assert ids(out) == ALL
    assert all(r.taken <= 3 * r["size"] for r in out.collect())
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and all(r.text.strip() for r in mixed.collect())
    assert mixing.mixture(none).count() == 0 and mixing.mixed(none).count() == 0


def test_quality(docs, none):
    out = perplexity.quality(docs)
    assert ids(out) == ALL
    assert all(r.perplexity is None and not r.kept for r in out.collect() if r.doc_id in (3, 4))
    assert perplexity.quality(none).count() == 0


PAGE_ROWS = [
    (1, "http://A.example.net/en/x?q#f", "<p>" + "same " * 40), (2, None, "<p>" + "same " * 40), (2, "no scheme", "<p>" + "same " * 40),
    (3, "x://", None), (4, "https://casino.example.org/", ""), (None, "http://example.com/de", "<p>" + "same " * 40), (None, None, None), (1, "http://A.example.net/en/x?q#f", "<p>" + "same " * 40),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, *([None] * 7)) for p in PAGE_ROWS], PAGES)


def test_warc(pages, spark):
    folder = new_path(spark, "edges")
    assert warc.write_archives(pages, folder) == len(PAGE_ROWS)
    out = warc.read_archives(spark, folder, range_bytes=97)  # ranges far smaller than records
    kinds = sorted((r.page_id is None, r.page_id, r.record_type, r.refers_to) for r in out.collect())
    assert len(kinds) == len(PAGE_ROWS)
    assert kinds.count((False, 1, "response", None)) == 2 and kinds.count((False, 2, "revisit", 1)) == 2
    assert (True, None, "revisit", 1) in kinds and (False, 3, "response", None) in kinds
    folder = new_path(spark, "edges")
    assert warc.write_archives(pages.limit(0), folder) == 0 and warc.read_archives(spark, folder).count() == 0


def test_urls(pages):
    out = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judged(pages).collect()]
    assert len(out) == len(PAGE_ROWS)
    assert out.count((1, "a.example.net", "/en/x", "example.net/en/", "allow")) == 2
    assert (4, "casino.example.org", "/", None, "block") in out and (2, "", "", None, "allow") in out and (None, "example.com", "/de", None, "allow") in out
    assert url_rules.judged(pages.limit(0)).count() == 0


def test_pages(pages):
    out = main_text.main_texts(pages)
    assert out.count() == len(PAGE_ROWS)
    assert {r.n_chars for r in out.collect() if r.page_id in (3, 4)} == {0}
    assert main_text.main_texts(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_the_columns_of_documents(name, stage, docs, none, spark):
    folder = "/root/testdata/sf0.001"
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, plain, folder).columns == plain.columns
    assert stage(spark, none.select(*plain.columns), folder).count() == 0

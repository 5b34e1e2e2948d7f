"""Every operator over nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import public_tokenizers
import pytest

import corpus_pipeline
from starloom.llm import fingerprints, jaccard, licenses, mixing, pieces, pii, rules, scoring, toxicity, warc

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _text string, kept string, class_id string, position string"
QUICK = pii.Training(windows=64, epochs=1)
BY_ROW = {
    "fingerprints": lambda d, _: fingerprints.fingerprint_edits(d),
    "pii": lambda d, _: pii.find_personal_data(d, ["doc_id"], how=QUICK),
    "scoring": lambda d, _: scoring.score(d, how=scoring.Scoring(steps=5)),
    "rules": lambda d, _: rules.measure(d, ["doc_id"]),
    "jaccard": lambda d, _: jaccard.similar(d),
    "toxicity": lambda d, labels: toxicity.grade(d, labels, how=toxicity.Fitting(steps=5)),
    "mixing": lambda d, _: mixing.mix(d, {"a": 2.0, "zzz": 1.0}),
    "pieces": lambda d, _: pieces.encode_documents(d, MODEL),
    "redact": lambda d, _: pii.redact_documents(d, how=QUICK),
    "mixed": lambda d, _: mixing.in_mixed_order(d, mixing.natural_weights(d, "source")),
}


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, columns with clashing names."""
    words = " ".join(f"word{k} part{k % 7}" for k in range(120))
    rows = [
        (1, words, "en", "a"), (2, words, "en", "a"), (2, words, "en", "a"), (3, words + " one two", None, "a"),
        (4, None, "en", None), (5, "", "de", "b"), (6, "  \n\n ", "de", "b"), (None, words, "en", "b"), (None, None, None, None),
        (7, "é中😀 " * 3000, "fr", "c"), (8, "x" * 20_000, "fr", "c"), (9, "call +1 (743) 555-3824 now", "en", "c"),
        (10, "one", "en", "c"), (11, "Released under the MIT License.\nyou idiot", "en", "c"),
    ]
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "x", "y", "z", None) for i, t, l, s in rows], DOCS)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def odd_labels(spark):
    rows = [(1, 1, 0), (3, 1, 0), (9, 1, 0), (11, 0, 1), (11, 0, 0), (8, 0, None), (None, 1, 1), (7, 5, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", BY_ROW)
def test_one_row_per_row(name, odd_docs, odd_labels):
    ids = [r[0] for r in odd_docs.select("doc_id").collect()]
    got = [r[0] for r in BY_ROW[name](odd_docs, odd_labels).select("doc_id").collect()]
    assert sorted(got, key=str) == sorted(ids, key=str)


@pytest.mark.parametrize("name", BY_ROW)
def test_empty_table(name, no_docs, odd_labels):
    assert BY_ROW[name](no_docs, odd_labels.limit(0)).count() == 0


def test_equal_texts_have_equal_fingerprints(odd_docs):
    found = fingerprints.fingerprint_edits(odd_docs).collect()
    same = {r.fingerprint for r in found if r.doc_id in (1, 2)}
    blank = {r.fingerprint for r in found if r.doc_id in (4, 5, 6)}
    assert len(same) == 1 and len(blank) == 1 and same != blank


def test_classes(odd_docs):
    found = {(r.doc_id, r.class_id, r.n_links) for r in jaccard.similar(odd_docs).collect()}
    assert {(1, 1, 4), (2, 1, 4), (3, 1, 4), (None, 1, 4), (4, 4, 0), (5, 5, 0), (10, 10, 0)} <= found


def test_one_of_each_class_stays(odd_docs):
    kept = jaccard.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 11]


def test_filter_keeps_columns(odd_docs, odd_labels):
    kept = rules.filter_documents(odd_docs, odd_labels)
    assert kept.columns == odd_docs.columns
    # 7 repeats the same words throughout, the others have too few.
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, None}


def test_redaction(odd_docs):
    texts = {r.doc_id: (r.text, r.n_chars) for r in pii.redact_documents(odd_docs, how=QUICK).collect()}
    assert texts[9] == ("call <PHONE> now", 16)


def test_licenses(odd_docs, no_docs):
    found = licenses.find_licenses(odd_docs).collect()
    assert [(r.doc_id, r.license, r.wording) for r in found] == [(11, "MIT", "Released under the MIT License")]
    assert licenses.find_licenses(no_docs).count() == 0


def test_pages(spark):
    rows = [(i, f"u{i}", "x" * 150 if i % 2 else "short") for i in range(1, 9)] + [(None, None, None), (1, "a\nb", "y" * 150), (9, "n", "x" * 150)]
    found = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    kinds = sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in found if r.page_id is not None)
    revisits = [(k, "revisit", 1, 150) for k in (3, 5, 7, 9)]
    assert kinds == sorted([(1, "response", None, 150)] * 2 + revisits + [(k, "response", None, 5) for k in (2, 4, 6, 8)], key=lambda r: r[:2])
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "sentencepiece_tokens"]

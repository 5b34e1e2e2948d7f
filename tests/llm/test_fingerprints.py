"""Fingerprints: many repeats, missing and repeated ids, and edited texts against a plain loop."""

import hashlib
from collections import Counter

import pytest

from starloom.llm import fingerprints
from starloom.llm.queries import QUERIES, table


@pytest.mark.parametrize("copies", [2**15, 2**16, 2**16 + 1, 2**17])
def test_copies_of_a_paragraph_count(copies):
    many, none, one, other = fingerprints.fingerprints(
        [b"x y z w\n" * copies, b"", b"x y z w", b"x y z w\n" * (copies - 1) + b"k l m n"]
    )
    for text in (none, one, other):
        digest = many[: fingerprints.DIGEST_WORDS] != text[: fingerprints.DIGEST_WORDS]
        assert digest.sum() > 12  # of 16 lanes, each of four words
    assert (fingerprints.delete(fingerprints.insert(many, "p q r"), "p q r") == many).all()


def _edited_digests(rows):
    """(id, n_chars, edited_sha256) by a plain loop: the next row by descending id, null ids last."""
    out = []
    for k, (key, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def _digests(found):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found.collect()), key=str)


def test_query_equals_a_plain_loop(spark, small):
    rows = [(r.doc_id, r.text or "") for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    rows.sort(key=lambda r: -r[0])
    assert _digests(QUERIES["op1_document_fingerprints"](spark, small)) == _edited_digests(rows)


@pytest.mark.parametrize("hot", [None, 2**60 + 1, 7])
def test_a_hot_id_is_spread_in_order(spark, hot):
    rows = [(hot, f"text {k} é{k % 13}") for k in range(600)] + [(2**60 + 2 * k, f"own {k}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = fingerprints.with_next(docs, "doc_id", "text").groupBy("_part").count().collect()
    assert max(r["count"] for r in held) < 350 and sum(r["count"] for r in held) <= 1200 + len(held)
    hashed = docs.selectExpr("doc_id", "text", "xxhash64(text) h").collect()
    ordered = sorted(hashed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h, r.text))
    assert _digests(fingerprints.fingerprint_edits(docs)) == _edited_digests([(r.doc_id, r.text) for r in ordered])


def test_one_row_and_only_missing_ids(spark):
    lone = spark.createDataFrame([(None, "ab")], "doc_id long, text string")
    assert _digests(fingerprints.fingerprint_edits(lone)) == _edited_digests([(None, "ab")])
    same = spark.createDataFrame([(None, None)] * 5 + [(None, "ab c")] * 5, "doc_id long, text string")
    assert Counter(r.n_chars for r in fingerprints.fingerprint_edits(same).collect()) == {0: 5, 4: 5}

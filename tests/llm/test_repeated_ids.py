"""The near-duplicate join where ids repeat or are missing, and its recall."""

import random
import re

import pytest

from starloom.llm import jaccard, queries

W = " ".join(f"apple{k} pear{k % 5}" for k in range(40))
V = " ".join(f"stone{k} river{k % 7}" for k in range(40))


def classes(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.similar(docs).collect()
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in found), key=str), len({r.class_key for r in found})


def kept(spark, rows):
    docs = spark.createDataFrame([(*row, "k") for row in rows], "doc_id long, text string, _key string")
    found = jaccard.keep_one(docs)
    assert found.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in found.collect()), key=str)


def test_repeated_rows_are_copies(spark):
    rows = [(1, W), (1, W), (3, W + " one two")]
    assert classes(spark, rows) == ([(1, 1, 2), (1, 1, 2), (3, 1, 2)], 1)
    assert kept(spark, rows) == [(1, W)]


def test_two_texts_under_one_id_are_two_texts(spark):
    rows = [(1, W), (1, V), (2, W + " one"), (3, V + " one")]
    assert classes(spark, rows) == ([(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)], 2)
    assert kept(spark, rows) == sorted([(1, W), (1, V)], key=str)


def test_rows_without_an_id_are_linked(spark):
    rows = [(None, W), (None, W + " one two"), (5, V), (None, V + " one two"), (None, "a lone text"), (None, "a lone text"), (None, None), (None, None)]
    found, n = classes(spark, rows)
    assert found == sorted([(None, None, 1), (None, None, 1), (5, 5, 1), (None, 5, 1), (None, None, 1), (None, None, 1), (None, None, 0), (None, None, 0)], key=str)
    assert n == 4
    stay = kept(spark, rows)
    assert [t for _, t in stay].count("a lone text") == 1 and (5, V) in stay and (None, None) in stay and len(stay) == 5


def test_no_clean_text_is_lost(spark):
    draw = random.Random(8)
    clean = [" ".join(draw.choices("abcdefghij", k=30)) for _ in range(60)]
    rows = [(draw.choice([None, 1, 2, k]), text) for k, text in enumerate(clean)]
    rows += [(draw.choice([None, 1, 2]), draw.choice(clean)) for _ in range(60)]
    assert sorted({t for _, t in kept(spark, rows)}) == sorted(set(clean)) and len(kept(spark, rows)) == len(set(clean))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_links_of_queried_documents(spark, folder):
    # Documents whose id is divisible by 50, against all documents, by their full n-gram sets.
    texts = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in queries.table(spark, folder, "documents").collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in texts.items()}
    found = {r.doc_id: r.n_links for r in queries.op6_ngram_jaccard_join(spark, folder).collect()}
    for i in (i for i in sets if i % 50 == 0 or found[i]):
        assert found[i] == sum(j != i and bool(sets[i]) and len(sets[i] & s) >= 0.8 * len(sets[i] | s) for j, s in sets.items())

"""What Python workers hold beside the texts at hand."""

import tracemalloc

import public_tokenizers
import pytest
from pyspark import RDD

from starloom.llm import mixing, pieces


@pytest.fixture
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return pieces.Pieces(file.read())


def held_by(model, texts):
    tracemalloc.start()
    try:
        for first in range(0, len(texts), 100):
            model.encode(texts[first : first + 100])
        return tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()


def test_a_remembered_part_costs_little(model):
    model.encode(["some words " * 2000])  # tables that grow with the longest batch
    texts = [" ".join(f"w{k}x{i}" for i in range(20)) for k in range(2000)]
    assert held_by(model, texts) < 40_000 * 250


def test_long_parts_are_bounded_in_bytes(model):
    texts = [f"{k:04}" + "ab" * 10_000 for k in range(1000)]
    model.encode(texts[:100])
    assert held_by(model, texts) < 50e6
    ids = model.library.encode(texts[-1:])
    assert model.encode(texts[-1:]).ids[0].tolist() == ids[0]


def test_ids_in_decimal(model):
    texts = ["", " ", "one two", "▁ whole"]
    for own in (texts, texts[:3]):
        assert [n.decode() for n in model.encode(own).numbers] == [",".join(map(str, i)) for i in model.library.encode(own)]


def test_the_mix_starts_no_further_kind_of_worker(spark, monkeypatch):
    docs = spark.range(100).selectExpr("id AS doc_id", "concat('s', id % 3) AS source")
    monkeypatch.setattr(RDD, "_to_java_object_rdd", lambda self: pytest.fail("rows of the driver go through a Python RDD"))
    assert mixing.mix(docs, {"s0": 1.0, "s1": 2.0, "s2": 1.0}, how=mixing.Mixing(block_rows=1, portion=20)).count() == 100

"""The mix against one sequential schedule, and its rows without ids."""

import random
from collections import Counter

import pytest

from starloom.llm import mixing
from starloom.llm.pfair import Plan


def test_stretches_agree_with_one_sequential_schedule():
    draw = random.Random(1)
    for _ in range(500):
        n = draw.randint(1, 9)
        whole = [draw.choice([1, 2, 3, 7, 50, 1000, draw.randint(1, 10**9)]) for _ in range(n)]
        blocks = [draw.choice([0, 1, 2, draw.randint(0, 60)]) for _ in range(n)]
        plan = Plan(whole, blocks, sum(whole) + draw.choice([0, 0, 5]))
        cuts, found, waiting = plan.cuts(draw.randint(1, 20)), [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            found += plan.slots(lo, hi, waiting)
            waiting = plan.waiting_at(lo, hi, waiting, plan.crowding(lo, hi))
        assert found == list(plan.slots(0, None, ())) and not waiting
        assert sorted((s, k) for _, s, k in found) == [(s, k) for s in range(n) for k in range(blocks[s])]


@pytest.mark.parametrize("portion", [40, 10**6])
def test_mix_of_many_stretches(spark, portion):
    counts = {f"s{k}": 3 + 17 * k % 41 for k in range(20)} | {"hot": 300}
    docs = spark.createDataFrame([(f"{s}-{i}", s) for s, n in counts.items() for i in range(n)], "doc_id string, source string")
    weights = {s: n**0.5 for s, n in counts.items()}
    how = mixing.Mixing(block_rows=1, run_blocks=8, portion=portion)
    rows = mixing.mix(docs, weights, how=how).collect()
    assert sorted((r.slot, r.source, r.block) for r in rows) == sorted(mixing.slots_of(mixing.whole_weights(weights), counts))
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())


def test_rows_without_id_or_with_one_id_are_cut_into_runs(spark):
    ids = [None] * 500 + ["same"] * 300 + [f"d{k}" for k in range(50)]
    docs = spark.createDataFrame([(i, "a") for i in ids], "doc_id string, source string")
    how = mixing.Mixing(block_rows=4, run_blocks=4)
    rows = mixing.mix(docs, {"a": 1.0}, how=how).collect()
    assert Counter(r.doc_id for r in rows) == Counter(ids)
    assert sorted(r.position for r in rows) == list(range(len(ids)))
    assert all(r.position == r.block * 4 + r.position % 4 and r.slot == r.block for r in rows)
    # One row an id before it meets its runs, so no task sorts the copies.
    assert mixing.numbered(docs, "source", "doc_id", 8).count() == 52

"""The merge of a batch into stored sales: every line goes once, straight to its month."""

from datetime import datetime
from decimal import Decimal

import pytest

from starloom import schemas
from starloom.sinks import upsert
from starloom.sinks.generations import Load
from starloom.sinks.upsert import FACT, LOADED, MONTH, read_stored, upsert_facts

T0, T1 = datetime(2026, 6, 1), datetime(2026, 6, 2)


def sales(spark, *rows):
    full = [(k, d, 1, 1, 1, 1, q, Decimal(q), Decimal(q), Decimal(3), None, Decimal(0), "livré") for k, d, q in rows]
    return spark.createDataFrame(full, schemas.TABLES[FACT])


def stored(spark, path):
    return sorted((r.id_commande, r.id_date, r.quantite_vendue, r.date_chargement.day) for r in read_stored(spark, path).collect())


@pytest.fixture
def loaded(spark, tmp_path):
    """Two months, two sales each."""
    rows = (("a", 20240105, 1), ("b", 20240106, 2), ("c", 20240207, 3), ("d", 20240208, 4))
    upsert_facts(sales(spark, *rows), str(tmp_path), T0)
    return str(tmp_path)


def merged(monkeypatch, batch, path):
    """The plan of the frame a load writes its sales from."""
    seen, whole = [], Load.rewrite

    def rewrite(load, name, df, *rest):
        seen.append(df)
        whole(load, name, df, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(Load, "rewrite", rewrite)
        upsert_facts(batch, path, T1)
    return seen[0]._jdf.queryExecution().executedPlan().toString()


def test_the_lines_of_a_merge_are_shuffled_once(spark, loaded, monkeypatch):
    plan = merged(monkeypatch, sales(spark, ("a", 20240105, 9), ("c", 20240301, 3), ("e", 20240402, 5)), loaded)
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange ") == 1
    assert stored(spark, loaded) == [
        ("a", 20240105, 9, 1), ("b", 20240106, 2, 1), ("c", 20240301, 3, 1), ("d", 20240208, 4, 1), ("e", 20240402, 5, 2),
    ]


def test_a_month_given_anew_is_not_read(spark, loaded, monkeypatch):
    plan = merged(monkeypatch, sales(spark, ("a", 20240105, 7), ("b", 20240301, 8), ("x", 20240109, 9)), loaded)
    assert "FileScan" in plan and "/fait_ventes" not in plan  # only the batch and the keys found in the index
    assert stored(spark, loaded) == [
        ("a", 20240105, 7, 1), ("b", 20240301, 8, 1), ("c", 20240207, 3, 1), ("d", 20240208, 4, 1), ("x", 20240109, 9, 2),
    ]


def test_large_months_are_cut_and_lines_still_meet(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "ROWS_PER_TASK", 7)
    path = str(tmp_path)
    upsert_facts(sales(spark, *[(f"k{i}", 20240101 + 100 * (i % 3), 1) for i in range(90)]), path, T0)
    upsert_facts(sales(spark, *[(f"k{i}", 20240201 + 100 * (i % 4), 2) for i in range(45, 120)]), path, T1)
    expected = [(f"k{i}", 20240101 + 100 * (i % 3), 1, 1) for i in range(45)]
    expected += [(f"k{i}", 20240201 + 100 * (i % 4), 2, 1 if i < 90 else 2) for i in range(45, 120)]
    assert stored(spark, path) == sorted(expected)
    upsert_facts(sales(spark, ("k1", 20240501, 3)), path, T1)  # the index knows where the moved lines are
    assert [r for r in stored(spark, path) if r[0] == "k1"] == [("k1", 20240501, 3, 1)]


def test_columns_left_out_stay_with_a_line_that_moves(spark, loaded):
    batch = sales(spark, ("a", 20240301, 7), ("n", 20240302, 7)).drop("cout_livraison", "remise_pct")
    upsert_facts(batch, loaded, T1)
    found = {r.id_commande: (r.cout_livraison, r.remise_pct) for r in read_stored(spark, loaded).collect()}
    assert found["a"] == (3, 0) and found["n"] == (None, 0) and len(found) == 5


def test_an_index_of_months_alone_still_gives_the_load_time(spark, tmp_path, monkeypatch):
    path, whole = str(tmp_path), upsert.add_lot
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "add_lot", lambda load, keys, key, month: whole(load, keys.drop(LOADED), key, month))
        upsert_facts(sales(spark, ("a", 20240105, 1), ("b", 20240106, 2)), path, T0)
    upsert_facts(sales(spark, ("a", 20240301, 1), ("b", 20240106, 5), ("c", 20240106, 3)), path, T1)
    assert stored(spark, path) == [("a", 20240301, 1, 1), ("b", 20240106, 5, 1), ("c", 20240106, 3, 2)]
    assert {r[MONTH] for r in read_stored(spark, path).select(MONTH).distinct().collect()} == {202401, 202403}

"""What the stream of raw order files writes before it knows which files are new."""

from datetime import datetime

from starloom import schemas
from starloom.plans import catalogue
from starloom.plans.warehouse import stored_star
from starloom.sources import files
from starloom.sources.retail_tables import RetailTables
from starloom.streaming import orders


def test_lines_are_not_staged_before_their_files_are_known_as_new(spark, small, monkeypatch):
    staged, plain = [], orders.stage
    monkeypatch.setattr(orders, "stage", lambda df, name: staged.append(name) or plain(df, name))
    catalogue.QUERIES["orders_stream"](spark, small)
    assert "arrivage" not in staged and staged.count("commandes") == 2
    # The files came a third time, to a stream without its checkpoint: their names alone are written.
    assert staged.count("fichiers") == 3 and staged[-1] == "fichiers"


def test_files_read_before_are_not_opened_and_names_are_no_patterns(spark, small, tmp_path, monkeypatch):
    inbox, root = tmp_path / "in", str(tmp_path / "w")
    inbox.mkdir()
    sources, opened, plain = RetailTables(spark, small), [], orders.read_listed_csv

    def deliver(name, key):
        line = f"{key},C1,P1,2024-03-15,2,10,livre,NATION_1,carte,L1,2024-03-16"
        (inbox / name).write_text(",".join(schemas.ORDER_COLUMNS) + f"\n{line}\n", encoding="utf-8")

    def load(mark):
        orders.load_orders(files.stream_files(spark, str(inbox)), sources, root, str(tmp_path / mark), datetime(2026, 6, 1))
        return sorted(r.id_commande for r in stored_star(spark, root)["fait_ventes"].collect())

    monkeypatch.setattr(orders, "read_listed_csv", lambda s, paths, columns: opened.append(len(paths)) or plain(s, paths, columns))
    deliver("o[12] é%20.csv", "CMD1")
    assert load("a") == ["CMD1"]
    deliver("o1 é%20.csv", "CMD2")
    assert load("a") == ["CMD1", "CMD2"]
    # Without the checkpoint all files are listed once more, and none is opened.
    assert load("b") == ["CMD1", "CMD2"] and opened == [1, 1]

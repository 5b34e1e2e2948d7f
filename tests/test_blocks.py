"""Records that span lines, from files cut at any byte."""

import csv
import json
import random

import pytest

from starloom import schemas
from starloom.sources import files
from starloom.sources.blocks import CsvRecords, JsonItems, State, cut, scan

WORDS = ["a", "", 'say "so"', "two\nlines", "x,y", '"', "\n\n", '5" pipe', "é ü", "\r\n", '""\n"', "end,\n"]
COLUMNS = schemas.CLIENT_COLUMNS


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "300")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _csv_file(path, seed, rows=300):
    draw = random.Random(seed)
    cells = [[f"{seed}-{k}", *[draw.choice(WORDS) for _ in COLUMNS[1:]]] for k in range(rows)]
    cells[rows // 2][3] = "long\n" * 400  # fills several blocks
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerows([COLUMNS, *cells])
    return cells


def test_csv_cut_inside_quotes(spark, small_blocks, tmp_path):
    expected = _csv_file(tmp_path / "a.csv", 1) + _csv_file(tmp_path / "b.csv", 2)
    got = files.read_clients(spark, str(tmp_path), multi_line=True).orderBy(schemas.ARRIVAL)
    rows = got.collect()
    assert [[r[c] for c in COLUMNS] for r in rows] == expected
    assert len({r[schemas.ARRIVAL]["_bloc"] for r in rows}) > 10


def test_csv_header_and_literal_quotes(spark, small_blocks, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n5" pipe,1\n\n  \na"b"c,"2\n3"\n"open,\n', encoding="utf-8")
    got = files.read_text_csv(spark, str(tmp_path), multi_line=True).orderBy(schemas.ARRIVAL).collect()
    assert [(r.x, r.y) for r in got][:2] == [('5" pipe', "1"), ('a"b"c', "2\n3")] and len(got) == 3
    (tmp_path / "b.csv").write_text("y,x\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="header differs"):
        files.read_text_csv(spark, str(tmp_path), multi_line=True).collect()


@pytest.mark.parametrize("indent", [None, 2])
def test_one_json_array_in_many_tasks(spark, small_blocks, tmp_path, indent):
    names = ["p", "}", '{"', '\\"}', "\\", "]}", "é", "x}\n" * 300]
    products = [
        {"id_produit": f"P{k}", "nom": names[k % len(names)], "prix_catalogue": float(k), "actif": k % 2 == 0}
        for k in range(200)
    ]
    products[7]["plus"] = {"a": {"b": 1}, "c": [{"d": "}"}]}
    (tmp_path / "p.json").write_text(json.dumps({"produits": products}, indent=indent), encoding="utf-8")
    rows = files.read_products(spark, str(tmp_path / "p.json")).orderBy(schemas.ARRIVAL).collect()
    assert [(r.id_produit, r.nom, r.prix_catalogue, r.actif) for r in rows] == [
        (p["id_produit"], p["nom"], p["prix_catalogue"], p["actif"]) for p in products
    ]
    assert len({r[schemas.ARRIVAL]["_bloc"] for r in rows}) > 10


def test_empty_documents_and_other_roots(spark, tmp_path):
    for name, text in (("a", ""), ("b", '{"produits": []}\n'), ("c", '{"produits": [{"id_produit": "P"}]}\n{"produits": [{}]}')):
        (tmp_path / f"{name}.json").write_text(text)
    assert [r.id_produit for r in files.read_products(spark, str(tmp_path)).orderBy(schemas.ARRIVAL).collect()] == ["P", None]
    (tmp_path / "d.json").write_text('{"autres": [{"id_produit": "Q"}]}')
    with pytest.raises(Exception, match="beside the array"):
        files.read_products(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("form", [CsvRecords(), JsonItems("a")])
def test_states_of_halves_give_the_state_of_the_whole(form):
    draw = random.Random(5)
    letters = '",x\\' if isinstance(form, CsvRecords) else '"{x\\'
    for _ in range(500):
        pieces = ["".join(draw.choice(letters) for _ in range(draw.randrange(6))) for _ in range(8)]
        whole, _ = scan(form, iter(pieces))
        middle, _ = scan(form, iter(pieces[:4]))
        out, inner = scan(form, iter(pieces[4:]))
        last = inner if middle.inside else out
        assert whole == State(last.inside, middle.depth + last.depth)


def test_cut_marks_what_crosses_a_block():
    assert list(cut(CsvRecords(), iter(['b",1', "c,2", 'd,"e']), State(True, 0))) == [
        (-1, False, 'b",1'), (1, True, "c,2"), (2, False, 'd,"e'),
    ]

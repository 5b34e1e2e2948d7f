import json
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators.cities import city_lookup
from starloom.operators.orders import latest_orders
from starloom.operators.quality import QualityError
from starloom.plans.facts import KEY_MAPS
from starloom.plans.warehouse import check_published, refresh_reports, run, stored_report, stored_star
from starloom.settings import Settings
from starloom.sinks import generations, key_index
from starloom.sinks.tables import publish_csv, replace_table
from starloom.sinks.upsert import read_stored, upsert_facts
from starloom.sources import files
from starloom.sources.delivered_files import DeliveredFiles
from starloom.streaming.arrivals import load_arrivals, raw_orders_to_facts, stream_facts

T0, T1 = datetime(2026, 6, 1), datetime(2026, 6, 2)


def test_text_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(' id , nom \n1,NULL\n2,\n3," x ""y"", z "\n2,NA\n', encoding="utf-8")
    df = files.read_text_csv(spark, str(path), ["id", "nom"])
    got = [(r.id, r.nom) for r in df.orderBy(schemas.ARRIVAL).collect()]
    assert got == [("1", "NULL"), ("2", ""), ("3", ' x "y", z '), ("2", "NA")]
    latest = latest_orders(df.withColumnRenamed("id", "id_commande"))
    assert {r.id_commande: r.nom for r in latest.collect()}["2"] == "NA"


def test_missing_columns_are_reported(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id\n1\n")
    with pytest.raises(ValueError, match="nom"):
        files.read_text_csv(spark, str(path), ["id", "nom"])


def test_products_json(spark, tmp_path):
    path = tmp_path / "p.json"
    items = [{"id_produit": f"P{i}", "nom": "é", "prix_catalogue": None if i else 5.5, "actif": bool(i)} for i in range(3)]
    path.write_text(json.dumps({"produits": items}, indent=1, ensure_ascii=False), encoding="utf-8")
    got = files.read_products(spark, str(path)).orderBy(schemas.ARRIVAL).collect()
    assert [(r.id_produit, r.prix_catalogue, r.actif) for r in got] == [("P0", 5.5, False), ("P1", None, True), ("P2", None, True)]


def fact(spark, *rows):
    full = [(k, d, 1, 1, 1, 1, q, Decimal(q), Decimal(q), None, None, Decimal(0), s) for k, d, q, s in rows]
    return spark.createDataFrame(full, schemas.TABLES["fait_ventes"])


def stored(spark, path):
    return sorted((r.id_commande, r.id_date, r.quantite_vendue, r.statut_commande, r.date_chargement.day) for r in read_stored(spark, path).collect())


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "f")
    assert read_stored(spark, path) is None
    upsert_facts(fact(spark, ("a", 20240105, 1, "en_cours"), ("b", 20240206, 2, "livré"), ("c", 20240307, 3, "livré")), path, T0)
    untouched = sorted((tmp_path / "f" / "annee_mois=202403").glob("*.parquet"))
    batch = fact(spark, ("a", 20240105, 9, "livré"), ("b", 20240108, 2, "livré"), ("d", 20240401, 4, "livré"))
    expected = [("a", 20240105, 9, "livré", 1), ("b", 20240108, 2, "livré", 1), ("c", 20240307, 3, "livré", 1), ("d", 20240401, 4, "livré", 2)]
    for _ in range(2):  # the second run changes nothing
        upsert_facts(batch, path, T1)
        assert stored(spark, path) == expected
    assert sorted((tmp_path / "f" / "annee_mois=202403").glob("*.parquet")) == untouched


def test_upsert_writes_null_over_a_value(spark, tmp_path):
    path = str(tmp_path / "f")
    row = fact(spark, ("a", 20240105, 1, "livré"))
    upsert_facts(row.withColumn("delai_livraison_jours", F.lit(3).cast("smallint")), path, T0)
    upsert_facts(row, path, T1)
    assert read_stored(spark, path).first().delai_livraison_jours is None


def test_upsert_updates_only_the_columns_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "f")
    upsert_facts(fact(spark, ("a", 20240105, 1, "livré")).withColumn("remise_pct", F.lit(5)), path, T0)
    partial = fact(spark, ("a", 20240105, 2, "livré"), ("b", 20240105, 3, "livré")).drop("remise_pct", "statut_commande")
    upsert_facts(partial, path, T1)
    got = {r.id_commande: (r.quantite_vendue, r.remise_pct, r.statut_commande) for r in read_stored(spark, path).collect()}
    assert got == {"a": (2, 5, "livré"), "b": (3, 0, None)}


@pytest.mark.parametrize(
    "rows, rule",
    [
        ([("a", 20240105, 1, "livré"), ("a", 20240105, 2, "livré")], "id_commande unique"),
        ([("a", 20240105, 1, "livré"), (None, 20240105, 2, "livré")], "id_commande not_null"),
        ([("a", None, 1, "livré")], "id_date not_null"),
        ([("a", 20240105, 0, "livré")], "quantite_vendue between"),
        ([("a", 20240105, 1, "perdu")], "statut_commande in_set"),
        ([("a" * 31, 20240105, 1, "livré")], "id_commande max_length"),
    ],
)
def test_upsert_refuses_a_batch_that_breaks_a_constraint(spark, tmp_path, rows, rule):
    with pytest.raises(QualityError, match=rule):
        upsert_facts(fact(spark, *rows), str(tmp_path / "f"), T0)
    assert read_stored(spark, str(tmp_path / "f")) is None


def test_upsert_keeps_the_given_load_time_in_any_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        upsert_facts(fact(spark, ("a", 20240105, 1, "livré")), str(tmp_path / "f"), T0)
        assert read_stored(spark, str(tmp_path / "f")).first().date_chargement == T0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_stream_is_replay_safe(spark, tmp_path):
    source, target, marks = str(tmp_path / "in"), str(tmp_path / "f"), str(tmp_path / "m")
    go = lambda: load_arrivals(stream_facts(spark, source, 1), lambda b: b, target, marks, T0)
    fact(spark, ("a", 20240105, 1, "en_cours"), ("b", 20240206, 2, "livré")).coalesce(1).write.parquet(source)
    go()
    fact(spark, ("a", 20240105, 5, "livré"), ("c", 20240206, 3, "livré")).coalesce(1).write.mode("append").parquet(source)
    go()
    once = stored(spark, target)
    assert [r[:3] for r in once] == [("a", 20240105, 5), ("b", 20240206, 2), ("c", 20240206, 3)]
    go()
    assert stored(spark, target) == once


def test_raw_orders_stream(spark, tmp_path):
    """Raw text files: the last line of an order in a file counts, later files correct earlier ones."""
    head = ",".join(schemas.ORDER_COLUMNS) + "\n"
    line = "{},C1,P1,{},{},10,{},TNG,carte,,\n".format
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text(
        head + line("A", "2024-01-05", 1, "OK") + line("A", "05/01/2024", 2, "KO") + line("B", "junk", 1, "OK"), encoding="utf-8"
    )
    regions = spark.createDataFrame([("Tanger", "TNG", 0)], "nom_ville_standard string, code_ville string, _arrivee int")
    dims = {
        "dim_produit": spark.createDataFrame([(4, "P1", True)], "id_produit_sk int, id_produit_nk string, est_actif boolean"),
        "dim_client": spark.createDataFrame([(5, "C1", True)], "id_client_sk int, id_client_nk string, est_actif boolean"),
        "dim_region": spark.createDataFrame([(6, "Tanger")], "id_region int, ville string"),
        "dim_livreur": spark.createDataFrame([(7, "-1")], "id_livreur int, id_livreur_nk string"),
    }
    to_facts = raw_orders_to_facts(city_lookup(regions), dims, {name: 1 for name in dims})
    target, marks = str(tmp_path / "f"), str(tmp_path / "m")
    go = lambda: load_arrivals(
        files.stream_text_csv(spark, str(tmp_path / "in"), schemas.ORDER_COLUMNS), to_facts, target, marks, T0
    )
    go()
    assert stored(spark, target) == [("A", 20240105, 2, "annulé", 1)]
    (tmp_path / "in" / "2.csv").write_text(head + line("A", "2024-02-05", 3, "DONE") + line("C", "2024-02-06", 1, "OK"), encoding="utf-8")
    go()
    assert stored(spark, target) == [("A", 20240205, 3, "livré", 1), ("C", 20240206, 1, "en_cours", 1)]
    first = read_stored(spark, target).filter("id_commande = 'A'").first()
    assert (first.id_produit, first.id_client, first.id_region, first.id_livreur) == (4, 5, 6, 7)


def test_published_tables_read_back(spark, tmp_path):
    table = fact(spark, ("a", 20240105, 1, "livré"), ("b", 20240206, 2, "annulé"))
    paths = publish_csv({"fait_ventes": table}, str(tmp_path))
    back = files.read_published_csv(spark, paths["fait_ventes"], "fait_ventes")
    assert back.dtypes == table.dtypes and sorted(back.collect()) == sorted(table.collect())


def test_missing_published_tables_are_passed_over(spark, tmp_path):
    with pytest.raises(ValueError, match="no table"):
        check_published(spark, str(tmp_path))
    publish_csv({"fait_ventes": fact(spark, ("a", 20240105, 1, "livré"), ("a", 20240105, -2, "?"))}, str(tmp_path))
    failed = {(r.colonne, r.regle) for r in check_published(spark, str(tmp_path)).collect() if not r.succes}
    assert failed == {("id_commande", "unique"), ("montant_ttc", "between"), ("quantite_vendue", "between"), ("statut_commande", "in_set")}


def test_replace(spark, tmp_path):
    path = str(tmp_path / "d")
    replace_table(spark.range(5), path)
    replace_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("as_tables", [True, False])
def test_whole_run_from_files(spark, tmp_path, as_tables):
    (tmp_path / "o.csv").write_text(
        "id_commande,id_client,id_produit,date_commande,quantite,prix_unitaire,statut,ville_livraison,mode_paiement,id_livreur,date_livraison\n"
        "CMD1,C1,P1,2024-03-15,2,100,livre,TNG,carte,L1,2024-03-18\n"
        "CMD1,C1,P1,2024-03-15,2,150.5,DONE,tnja,carte,L1,18/03/2024\n"
        "CMD2,C2,P2,15/04/2024,1,10,KO,casa,carte,,\n"
        "CMD3,C2,P2,Apr 16 2024,-1,10,OK,casa,carte,,\n"
        "CMD4,C2,P2,junk,1,10,OK,casa,carte,,\n"
        "CMD5,C2,P2,2024-04-16,1,0,OK,casa,carte,,\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text(
        "id_client,nom,prenom,email,date_naissance,sexe,ville,telephone,date_inscription,canal_acquisition\n"
        "C1,alami,sara,s@x.ma,1990-01-01,Femme,Tanger,,2023-01-01,Web\n"
        "C2,idrissi,ali,A@x.ma,2023-01-01,1,Casa,,2022-01-01,Web\n"
        "C3,idrissi,ali,a@x.ma,1980-01-01,1,Nulle part,,2021-01-01,Web\n", encoding="utf-8")
    (tmp_path / "p.json").write_text(json.dumps({"produits": [
        {"id_produit": "P1", "nom": "Tél", "categorie": "ELECTRONIQUE", "sous_categorie": "x", "marque": "A", "fournisseur": "B",
         "prix_catalogue": 99.5, "origine_pays": "USA", "date_creation": "2020-01-01", "actif": False}]}), encoding="utf-8")
    (tmp_path / "r.csv").write_text(
        "code_ville,nom_ville_standard,province,region_admin,zone_geo,population,code_postal\n"
        "TNG,Tanger,F,Tanger-Tétouan,Nord,1,1\nCAS,Casablanca,C,Casablanca-Settat,Centre,1,1\n", encoding="utf-8")
    sources = DeliveredFiles(spark, *[str(tmp_path / n) for n in ("o.csv", "c.csv", "p.json", "r.csv")])
    out = str(tmp_path / "out")
    built = run(spark, sources, out, loaded_at=T0, as_tables=as_tables)
    star = stored_star(spark, out) if as_tables else {t: files.read_published_csv(spark, f"{out}/{t}", t) for t in schemas.TABLES}
    sales = {r.id_commande: r for r in star["fait_ventes"].collect()}
    assert sorted(sales) == ["CMD1", "CMD2"]
    assert (sales["CMD1"].montant_ht, sales["CMD1"].montant_ttc) == (Decimal("301.00"), Decimal("361.20"))
    assert (sales["CMD1"].delai_livraison_jours, sales["CMD1"].statut_commande, sales["CMD1"].id_region) == (3, "livré", 1)
    assert (sales["CMD2"].statut_commande, sales["CMD2"].id_region, sales["CMD2"].id_produit) == ("annulé", 2, 1)
    assert star["dim_temps"].count() == 2192
    people = {r.id_client_nk: r for r in star["dim_client"].collect()}
    assert sorted(people) == ["C1", "C2"] and people["C1"].nom_complet == "Sara Alami"
    assert people["C2"].id_client_sk == 1 and people["C2"].tranche_age == "<18"
    assert built.report("mv_ca_mensuel").first().ca_ttc == Decimal("361.20")
    if as_tables:
        refresh_reports(spark, out, T1)
        assert stored_report(spark, out, "mv_top_produits").first().rang_global == 1


def test_second_run_keeps_sales_with_their_clients(spark, tmp_path):
    """C2 signed up before C1 but arrives with the second run only."""
    orders = ",".join(schemas.ORDER_COLUMNS) + "\n"
    clients = ",".join(schemas.CLIENT_COLUMNS) + "\n"
    line = "{},{},{},{},1,10,livre,{},carte,{},\n".format
    person = "{},alami,sara,{}@x.ma,1990-01-01,F,Tanger,,{},Web\n".format
    product = lambda name: {"id_produit": name, "nom": name, "categorie": "x", "sous_categorie": "x", "marque": "A",
                            "fournisseur": "B", "prix_catalogue": 9.5, "origine_pays": "USA", "date_creation": "", "actif": True}
    regions = ",".join(schemas.REGION_COLUMNS) + "\nTNG,Tanger,F,Nord,Nord,1,1\n"

    def deliver(day, order_lines, people, products, cities):
        folder = tmp_path / str(day)
        folder.mkdir(exist_ok=True)
        files_ = {"o.csv": orders + order_lines, "c.csv": clients + people, "p.json": json.dumps({"produits": products}), "r.csv": cities}
        for name, text in files_.items():
            (folder / name).write_text(text, encoding="utf-8")
        sources = DeliveredFiles(spark, *[str(folder / n) for n in ("o.csv", "c.csv", "p.json", "r.csv")])
        run(spark, sources, str(tmp_path / "out"), Settings(as_of=date(2026, 6, day)), loaded_at=T0)

    def sales():
        star = stored_star(spark, str(tmp_path / "out"))
        found = star["fait_ventes"].select("id_commande", *[k.output for k in KEY_MAPS])
        for k in KEY_MAPS:
            found = found.join(star[k.dimension].select(F.col(k.surrogate).alias(k.output), k.natural), k.output).drop(k.output)
        return sorted(tuple(r) for r in found.collect())

    one = ("CMD1", "P9", "C1", "Tanger", "L9")
    two = ("CMD2", "P1", "C2", "Agadir", "L1")
    deliver(1, line("CMD1", "C1", "P9", "2024-03-15", "TNG", "L9"), person("C1", "a", "2023-01-01"), [product("P9")], regions)
    assert sales() == [one]
    second = (2, line("CMD2", "C2", "P1", "2024-03-16", "AGA", "L1"), person("C2", "b", "2022-01-01") + person("C1", "a", "2023-01-01"),
              [product("P1"), product("P9")], regions.replace("TNG", "AGA,Agadir,A,Sud,Sud,1,1\nTNG"))
    deliver(*second)
    assert sales() == [one, two]
    deliver(*second)
    assert sales() == [one, two]
    kept = stored_star(spark, str(tmp_path / "out"))["dim_client"].groupBy("id_client_nk").count().collect()
    # C1 was Bronze on both days: no new version. The run of the same day adds none either.
    assert {r.id_client_nk: r["count"] for r in kept} == {"C1": 1, "C2": 1}


@pytest.mark.parametrize("step, after", [("replace", True), ("rewrite", True), ("add_lot", False), ("update_reports", True), ("publish", False)])
def test_readers_see_a_load_whole_or_not_at_all(spark, tmp_path, monkeypatch, step, after):
    """A load that dies at any step leaves the generation before, and can be run again."""
    from starloom.plans import warehouse as plans
    from starloom.sinks import upsert

    root, star = str(tmp_path / "w"), tiny_star(spark)
    load_star(spark, root, star, fact(spark, ("a", 20240105, 1, "livré"), ("b", 20240106, 2, "livré")), T0)
    places = {"add_lot": upsert, "update_reports": plans}
    place = places.get(step, generations.Load)
    whole = getattr(place, step)

    def crash(*args):
        if after:
            whole(*args)
        raise RuntimeError("lost")

    moved = fact(spark, ("a", 20240205, 1, "livré"), ("c", 20240206, 5, "livré"))
    monkeypatch.setattr(place, step, crash)
    with pytest.raises(RuntimeError, match="lost"):
        load_star(spark, root, star, moved, T1)
    monkeypatch.undo()
    assert seen(spark, root) == ([("a", 20240105, 1), ("b", 20240106, 2)], {202401: 3})
    load_star(spark, root, star, moved, T1)
    assert seen(spark, root) == ([("a", 20240205, 1), ("b", 20240106, 2), ("c", 20240206, 5)], {202401: 2, 202402: 6})
    before = generations.generations(spark, root, 2)[1]
    assert plans.star_of(spark, root, before)["fait_ventes"].count() == 2
    gone = generations.retire(spark, root, keep=1)
    assert gone and seen(spark, root)[1] == {202401: 2, 202402: 6}
    assert generations.retire(spark, root, keep=1) == []


def tiny_star(spark):
    days = "id_date int, jour int, mois int, trimestre int, annee int, semaine int, libelle_jour string, libelle_mois string, est_weekend boolean, est_ferie_maroc boolean, periode_ramadan boolean"
    rows = [(20240000 + m * 100 + d, d, m, (m + 2) // 3, 2024, 1, "j", "m", False, False, False) for m in range(1, 6) for d in range(1, 29)]
    end = date(9999, 12, 31)
    return {
        "dim_temps": spark.createDataFrame(rows, days),
        "dim_produit": spark.createDataFrame([(1, "P", "p", "c", "s", "m", "f", Decimal(1), "o", T0.date(), end, True)], schemas.TABLES["dim_produit"]),
        "dim_client": spark.createDataFrame([(1, "C", "n", "a", "m", "v", "r", "Gold", "w", T0.date(), end, True)], schemas.TABLES["dim_client"]),
        "dim_region": spark.createDataFrame([(1, "v", "p", "r", "z", "Maroc")], schemas.TABLES["dim_region"]),
        "dim_livreur": spark.createDataFrame([(1, "L", "l", "t", "z")], schemas.TABLES["dim_livreur"]),
    }


def load_star(spark, root, star, sales, day):
    from starloom.plans import warehouse as plans
    from starloom.sinks import upsert

    load = generations.Load(spark, root)
    for name, df in star.items():
        load.replace(name, df)
    touched = upsert.merge_facts(load, sales, day)
    plans.update_reports(load, {name: 1 for name in star}, touched)
    load.publish(day)
    return load


def seen(spark, root):
    sales = sorted((r.id_commande, r.id_date, r.quantite_vendue) for r in stored_star(spark, root)["fait_ventes"].collect())
    return sales, {r.annee * 100 + r.mois: r.volume_vendu for r in stored_report(spark, root, "mv_ca_mensuel").collect()}


def test_untouched_periods_are_not_written_again(spark, tmp_path):
    root, star = str(tmp_path / "w"), tiny_star(spark)
    first = load_star(spark, root, star, fact(spark, ("a", 20240105, 1, "livré"), ("b", 20240406, 2, "livré")), T0)
    second = load_star(spark, root, star, fact(spark, ("c", 20240205, 4, "livré")), T1)
    assert second.next.parts["fait_ventes"] == {202401: first.token, 202404: first.token, 202402: second.token}
    assert second.next.parts["mv_ca_mensuel"] == {202401: first.token, 202404: first.token, 202402: second.token}
    # The first quarter is aggregated again from both of its months, the second stays.
    assert second.next.parts["mv_top_produits"] == {20241: second.token, 20242: first.token}
    assert {r.trimestre: r.qte_totale for r in stored_report(spark, root, "mv_top_produits").collect()} == {1: 5, 2: 2}
    renamed = {**star, "dim_produit": star["dim_produit"].withColumn("nom_produit", F.lit("neu"))}
    third = load_star(spark, root, renamed, fact(spark, ("d", 20240305, 1, "annulé")), T1)
    # Only the report that shows the name is built whole.
    assert set(third.next.parts["mv_top_produits"].values()) == {third.token}
    assert {r.nom_produit for r in stored_report(spark, root, "mv_top_produits").collect()} == {"neu"}
    assert third.next.parts["mv_ca_mensuel"] == second.next.parts["mv_ca_mensuel"]


def test_of_two_loads_from_one_generation_the_second_is_refused(spark, tmp_path):
    one, two = generations.Load(spark, str(tmp_path)), generations.Load(spark, str(tmp_path))
    for load in (one, two):
        load.replace("t", spark.range(3))
    one.publish(T0)
    with pytest.raises(RuntimeError, match="another load"):
        two.publish(T0)
    assert generations.current(spark, str(tmp_path)).tables == {"t": one.token}


@pytest.fixture
def indexed(spark, tmp_path, monkeypatch):
    """100 keys in many small cells and buckets."""
    monkeypatch.setattr(key_index, "CELL_KEYS", 5)
    load = generations.Load(spark, str(tmp_path))
    key_index.add_lot(load, spark.range(100).selectExpr("concat('k', id) as k", "cast(202401 + id % 3 as int) as m"), "k", "m")
    return load


def keys_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def test_the_index_reads_touched_buckets_only(spark, indexed):
    asked = keys_of(spark, "k7", "k7x", "k12")
    found = key_index.known_months(spark, indexed.root, indexed.next, asked, "k", "m")
    assert sorted(tuple(r) for r in found.collect()) == [("k12", 202401), ("k7", 202402)]
    touched = {r.paquet for r in key_index.candidates(spark, indexed.root, indexed.next, asked, "k").collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*paquet", plan) and len(touched) < indexed.next.buckets
    unseen = keys_of(spark, *[f"u{k}" for k in range(500)])
    assert key_index.candidates(spark, indexed.root, indexed.next, unseen, "k").count() < 25
    assert key_index.known_months(spark, indexed.root, indexed.next, unseen, "k", "m").count() == 0


def test_a_false_positive_of_a_filter_changes_nothing(spark, indexed, monkeypatch):
    monkeypatch.setattr(key_index, "_is_set", lambda bitmap, position: F.col(bitmap).isNotNull())
    asked = keys_of(spark, "k3", *[f"u{k}" for k in range(50)])
    assert key_index.candidates(spark, indexed.root, indexed.next, asked, "k").count() > 10
    found = key_index.known_months(spark, indexed.root, indexed.next, asked, "k", "m")
    assert [tuple(r) for r in found.collect()] == [("k3", 202401)]


def test_the_newest_lot_is_right_and_lots_are_merged(spark, indexed, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_LOTS", 2)
    for turn in range(4):
        indexed.token = f"t{turn}"
        key_index.add_lot(indexed, spark.createDataFrame([("k1", 202500 + turn), (f"n{turn}", 202601)], "k string, m int"), "k", "m")
        key_index.merge_lots(indexed, "k", "m")
        assert len(indexed.next.lots) <= 2
    found = key_index.known_months(spark, indexed.root, indexed.next, keys_of(spark, "k1", "k2", "n0", "n3", "n4"), "k", "m")
    assert sorted(tuple(r) for r in found.collect()) == [("k1", 202503), ("k2", 202403), ("n0", 202601), ("n3", 202601)]


def test_few_keys_are_tried_where_they_touch_every_bucket(spark, indexed, monkeypatch):
    monkeypatch.setattr(key_index, "FEW", 2)
    tried, plain = [], key_index.candidates
    monkeypatch.setattr(key_index, "candidates", lambda s, r, h, keys, key: tried.append(keys.count()) or plain(s, r, h, keys, key))
    everything = spark.range(100).selectExpr("concat('k', id) as k")
    touched = {(r[0], r[1]) for r in key_index.touched_buckets(spark, indexed.root, indexed.next, everything, "k")}
    assert len(touched) == indexed.next.buckets and len(tried) == 1 and tried[0] < 80
    assert key_index.known_months(spark, indexed.root, indexed.next, everything, "k", "m").count() == 100
    # One key is not tried in vain if it is not among the few.
    for k in range(8):
        tried.clear()
        assert key_index.known_months(spark, indexed.root, indexed.next, keys_of(spark, f"k{k}"), "k", "m").count() == 1
        assert tried[-1] == 1 and len(tried) == 2


def test_filters_are_one_file_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "CELL_KEYS", 5)
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 250)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        load = generations.Load(spark, str(tmp_path))
        key_index.add_lot(load, spark.range(2500).selectExpr("concat('k', id) as k", "202401 as m"), "k", "m")
    finally:
        spark.conf.set(coalesce, before)
    assert load.next.buckets == 10 and len(list(tmp_path.glob("filtres/*/paquet=*/*.parquet"))) == 10
    assert key_index.known_months(spark, load.root, load.next, keys_of(spark, "k7", "k2600"), "k", "m").collect() == [("k7", 202401)]


def test_dimensions_are_compared_by_a_shuffle_unless_counted_as_small(spark, tmp_path, monkeypatch):
    from dataclasses import replace

    from starloom.plans import warehouse as plans

    star, asked, plain = tiny_star(spark), [], plans.sized
    load_star(spark, str(tmp_path), star, fact(spark, ("a", 20240105, 1, "livré")), T0)
    monkeypatch.setattr(plans, "sized", lambda df, rows, limit: asked.append((rows, limit)) or plain(df, rows, limit))
    load = generations.Load(spark, str(tmp_path))
    for name, df in {**star, "dim_region": star["dim_region"].withColumn("ville", F.lit("neu"))}.items():
        load.replace(name, df)
    changed = {
        name: plans._attributes_changed(load, name, tuple(columns), 7, replace(Settings(), broadcast_rows=limit))
        for name, columns, limit in (("dim_region", ("id_region", "ville"), 3), ("dim_produit", ("id_produit_sk", "categorie"), 7))
    }
    assert changed == {"dim_region": True, "dim_produit": False} and asked == [(7, 3), (7, 7)]
    marked = [plain(spark.range(7), *sizes)._jdf.queryExecution().analyzed().toString() for sizes in asked]
    assert "merge" in marked[0] and "broadcast" in marked[1]

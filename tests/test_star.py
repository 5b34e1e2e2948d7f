import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators.asof import attach_as_of
from starloom.operators.surrogate import assign_keys
from starloom.operators.versions import merge_versions
from starloom.plans import dimensions as dims
from starloom.plans.facts import sales_fact
from starloom.settings import Settings


@pytest.fixture(scope="module")
def calendar(spark):
    return dims.calendar_dimension(spark).cache()


def test_calendar(calendar):
    assert calendar.count() == 2192
    assert calendar.filter("periode_ramadan").count() == 180
    assert calendar.filter("est_ferie_maroc").count() == 54
    day = calendar.filter("id_date = 20240315").first()
    assert (day.jour, day.mois, day.trimestre, day.annee, day.semaine) == (15, 3, 1, 2024, 11)
    assert (day.libelle_jour, day.libelle_mois, day.est_weekend, day.periode_ramadan) == ("Vendredi", "Mars", False, True)


def test_calendar_uses_iso_weeks(calendar):
    first = calendar.filter("id_date = 20210101").first()
    assert (first.semaine, first.est_ferie_maroc) == (53, True)
    assert calendar.filter("id_date = 20240316").first().est_weekend


def test_keys_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    keyed = assign_keys(df, [F.col("v")], "cle", after=10)
    assert keyed.filter("cle <> v + 11").isEmpty() and keyed.count() == 1000


@pytest.fixture
def tables(frame):
    products = frame(
        "id_produit string, nom string, prix_catalogue double, categorie string, sous_categorie string, marque string, "
        "fournisseur string, origine_pays string",
        ("P001", "iPhone", 8000.0, "Electronique", "Telephones", "Apple", "FournA", "Chine"),
        ("P002", "Table", 800.0, "Meubles", "Tables", "Bois", "FournB", "Maroc"),
    )
    regions = frame(
        "nom_ville_standard string, province string, region_admin string, zone_geo string, code_ville string",
        ("Casablanca", "Casablanca", "Casablanca-Settat", "Nord", "CAS"),
        ("Tanger", "Fahs-Anjra", "Tanger-Tétouan", "Nord", "TNG"),
    )
    clients = frame(
        "id_client string, prenom string, nom string, tranche_age string, sexe string, ville string, canal_acquisition string",
        ("C001", " yassir", "el-test ", "25-34", "m", "Casablanca", "Web"),
        ("C002", "Sara", "T", "25-34", "f", "Ailleurs", "Web"),
    )
    segments = frame("id_client string, segment_client string, ca_12m double", ("C001", "Gold", 20000.0))
    orders = frame(
        "id_commande string, date_commande date, id_produit string, id_client string, ville_livraison string, "
        "id_livreur string, quantite int, montant_ht decimal(18,2), montant_ttc decimal(18,2), "
        "delai_livraison_jours int, statut string",
        ("CMD-001", date(2024, 1, 15), "P001", "C001", "Casablanca", "-1", 1, Decimal("6666.67"), Decimal("8000"), 3, "livré"),
        ("CMD-002", date(2024, 1, 16), "P002", "C002", "Tanger", "L7", 2, Decimal("13333.33"), Decimal("16000"), 4, "livré"),
        ("CMD-003", date(2024, 1, 17), "P999", "C999", "Non renseignée", "L7", 2, Decimal("1"), Decimal("1.20"), None, "en_cours"),
    )
    return products, regions, clients, segments, orders


def build(tables, settings=Settings(), orders=None):
    products, regions, clients, segments, cleaned = tables
    built = {
        "dim_produit": dims.product_dimension(products, settings),
        "dim_region": dims.region_dimension(regions, settings),
        "dim_client": dims.client_dimension(clients, segments, regions, settings),
        "dim_livreur": dims.courier_dimension(orders if orders is not None else cleaned),
    }
    return built, {k: v.count() for k, v in built.items()}


def test_dimensions(tables):
    built, _ = build(tables)
    clients = {r.id_client_nk: r for r in built["dim_client"].collect()}
    assert clients["C001"].nom_complet == "Yassir El-Test" and clients["C001"].segment_client == "Gold"
    assert clients["C001"].region_admin == "Casablanca-Settat"
    assert (clients["C002"].segment_client, clients["C002"].region_admin) == ("Bronze", "Non renseignée")
    assert (clients["C001"].date_debut, clients["C001"].date_fin) == (Settings().as_of, date(9999, 12, 31))
    couriers = {r.id_livreur_nk: r for r in built["dim_livreur"].collect()}
    assert (couriers["-1"].id_livreur, couriers["-1"].nom_livreur) == (1, "Livreur inconnu")
    assert couriers["L7"].nom_livreur == "Livreur L7"
    assert [r.pays for r in built["dim_region"].collect()] == ["Maroc", "Maroc"]


def test_unknown_courier_always_exists(frame):
    only = dims.courier_dimension(frame("id_livreur string", ("L1",), (None,))).collect()
    assert sorted((r.id_livreur, r.id_livreur_nk) for r in only) == [(1, "-1"), (2, "L1")]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_fact_keys(tables, limit):
    """Both ways of the key join: counted broadcast, and shuffle with hot keys set aside."""
    settings = Settings(broadcast_rows=limit)
    built, rows = build(tables, settings)
    fact = {r.id_commande: r for r in sales_fact(tables[4], built, rows, settings).collect()}
    assert sorted(fact) == ["CMD-001", "CMD-002", "CMD-003"]
    one, two, three = (fact[k] for k in sorted(fact))
    assert (one.id_date, one.id_produit, one.id_client, one.id_region, one.id_livreur) == (20240115, 1, 1, 1, 1)
    assert (two.id_produit, two.id_client, two.id_region, two.id_livreur) == (2, 2, 2, 2)
    assert (three.id_produit, three.id_client, three.id_region) == (1, 1, 1)
    assert (two.quantite_vendue, two.montant_ttc, two.remise_pct, two.cout_livraison) == (2, Decimal(16000), Decimal(0), None)


def test_repeated_natural_keys_do_not_double_sales(tables):
    built, rows = build(tables)
    twice = built["dim_produit"].filter("id_produit_nk = 'P001'").withColumn("id_produit_sk", F.lit(9))
    built["dim_produit"] = built["dim_produit"].unionByName(twice)
    sales = sales_fact(tables[4], built, rows).filter("id_commande = 'CMD-001'").collect()
    assert [r.id_produit for r in sales] == [9]


def test_unresolved_key_is_a_setting(tables):
    settings = Settings(unresolved_sk=-1)
    built, rows = build(tables, settings)
    lost = sales_fact(tables[4], built, rows, settings).filter("id_commande = 'CMD-003'").first()
    assert (lost.id_produit, lost.id_client, lost.id_region) == (-1, -1, -1)


def test_history_merge(frame):
    schema = "sk int, nk string, seg string, date_debut date, date_fin date, est_actif boolean"
    start, end = date(2024, 1, 1), date(9999, 12, 31)
    current = frame(schema, (1, "a", "Gold", start, end, True), (2, "b", None, start, end, True),
                    (3, "c", "Gold", start, date(2024, 5, 1), False), (4, "c", "Bronze", date(2024, 5, 2), end, True),
                    (5, "d", "Gold", start, end, True))
    incoming = frame("nk string, seg string", ("a", "Silver"), ("b", None), ("c", "Bronze"), ("e", "Gold"))
    merged = merge_versions(current, incoming, "sk", "nk", ["seg"], date(2025, 1, 1))
    got = sorted(tuple(r) for r in merged.collect())
    assert got == [
        (1, "a", "Gold", start, date(2024, 12, 31), False),
        (2, "b", None, start, end, True),
        (3, "c", "Gold", start, date(2024, 5, 1), False),
        (4, "c", "Bronze", date(2024, 5, 2), end, True),
        (5, "d", "Gold", start, end, True),
        (6, "a", "Silver", date(2025, 1, 1), end, True),
        (7, "e", "Gold", date(2025, 1, 1), end, True),
    ]


def test_untracked_columns_are_updated_in_place(frame):
    schema = "sk int, nk string, seg string, ville string, date_debut date, date_fin date, est_actif boolean"
    end = date(9999, 12, 31)
    current = frame(schema, (1, "a", "Gold", "X", date(2024, 1, 1), end, True), (2, "b", "Gold", "X", date(2024, 6, 1), end, True))
    incoming = frame("nk string, seg string, ville string", ("a", "Gold", "Y"), ("b", "Bronze", "Z"), ("c", "Silver", "W"))
    merged = merge_versions(current, incoming, "sk", "nk", ["seg"], date(2024, 6, 1))
    rows = {(r.sk, r.nk, r.seg, r.ville, r.est_actif) for r in merged.collect()}
    assert {(1, "a", "Gold", "Y", True), (3, "c", "Silver", "W", True)} <= rows
    # b opened on the same day: changed in place.
    assert {r for r in rows if r[1] == "b"} == {(2, "b", "Bronze", "Z", True)}


SEEN = "sk int, nk string, seg string, ville string, date_debut date, date_fin date, est_actif boolean"
END = date(9999, 12, 31)


def day(month):
    return date(2024, month, 1)


def test_back_dated_runs(frame):
    """Runs of months 4, 7 and 10 are stored; the run of month 5 comes late."""
    current = frame(
        SEEN,
        (1, "changed since", "A", "x", day(4), date(2024, 6, 30), False), (2, "changed since", "B", "x", day(7), END, True),
        (3, "as the next", "A", "x", day(4), date(2024, 6, 30), False), (4, "as the next", "B", "x", day(7), END, True),
        (5, "open", "A", "x", day(4), END, True), (6, "equal", "A", "x", day(4), END, True),
        (7, "younger", "B", "x", day(10), END, True), (8, "younger, equal", "A", "x", day(7), END, True),
        (9, "missing", "A", "x", day(4), END, True), (10, None, "A", "x", day(4), END, True),
    )
    names = {"changed since": "C", "as the next": "B", "open": "C", "equal": "A", "younger": "A", "younger, equal": "A", "new": "A"}
    incoming = frame("nk string, seg string, ville string", *[(n, s, "old") for n, s in names.items()])
    merged = merge_versions(current, incoming, "sk", "nk", ["seg"], day(5))
    assert merged.columns == current.columns
    got = sorted((tuple(r) for r in merged.collect()), key=lambda r: (str(r[1]), r[4]))
    may = date(2024, 4, 30)
    assert got == [
        (10, None, "A", "x", day(4), END, True),
        (3, "as the next", "A", "x", day(4), may, False), (4, "as the next", "B", "x", day(5), END, True),
        (1, "changed since", "A", "x", day(4), may, False), (11, "changed since", "C", "old", day(5), date(2024, 6, 30), False),
        (2, "changed since", "B", "x", day(7), END, True),
        (6, "equal", "A", "x", day(4), END, True), (9, "missing", "A", "x", day(4), END, True),
        (12, "new", "A", "old", day(5), END, True),
        (5, "open", "A", "x", day(4), may, False), (13, "open", "C", "old", day(5), date(2024, 6, 30), False),
        (14, "open", "A", "x", day(7), END, True),
        (15, "younger", "A", "old", day(5), date(2024, 9, 30), False), (7, "younger", "B", "x", day(10), END, True),
        (8, "younger, equal", "A", "x", day(5), END, True),
    ]


def test_runs_in_any_order_tell_one_history(spark):
    """Whatever the order of the runs, no version ends before it starts and each day has the state last seen before it."""
    draw = random.Random(3)
    for _ in range(4):
        months = draw.sample(range(1, 13), 4)
        states = {m: {n: draw.choice("AB") for n in "pqrstu" if draw.random() < 0.8} for m in months}
        table, done = spark.createDataFrame([], SEEN), []
        for m in months:
            later = [day(k) for k in done if k > m]
            done.append(m)
            incoming = spark.createDataFrame([(n, s, "v") for n, s in states[m].items()], "nk string, seg string, ville string")
            table = spark.createDataFrame(merge_versions(table, incoming, "sk", "nk", ["seg"], day(m), min(later, default=None)).collect(), SEEN)
        rows = table.collect()
        assert len({r.sk for r in rows}) == len(rows) and all(r.date_debut <= r.date_fin for r in rows)
        assert all(r.est_actif == (r.date_fin == END) for r in rows)
        for n in "pqrstu":
            for m in months:
                if n in states[m]:
                    assert [r.seg for r in rows if r.nk == n and r.date_debut <= day(m) <= r.date_fin] == [states[m][n]]


@pytest.mark.parametrize("limit", [1000, 0])
@pytest.mark.parametrize("hot", [None, ["k0", "k1"], []])
def test_versions_on_the_day(spark, limit, hot):
    draw = random.Random(limit)
    versions = [(f"k{k}", date(2024, 1, 1) + timedelta(draw.randrange(300)), k * 100 + j) for k in range(20) for j in range(draw.randrange(6))]
    versions.append((None, date(2024, 1, 1), 7))
    facts = [(draw.choice(["k0"] * 9 + [f"k{k}" for k in range(23)] + [None]), draw.choice([None, date(2024, 1, 1) + timedelta(draw.randrange(400))]), i) for i in range(800)]
    table = spark.createDataFrame(versions, "nk string, debut date, sk int")
    found = attach_as_of(spark.createDataFrame(facts, "nk string, jour date, i int"), table, "nk", F.col("jour"), "debut", ["sk"], F.col("i"), len(versions), limit, hot)
    assert found.columns == ["nk", "jour", "i", "sk"]
    want = []
    for nk, jour, i in facts:
        mine = sorted((d, sk) for n, d, sk in versions if n == nk and nk is not None)
        begun = [v for v in mine if jour is not None and v[0] <= jour]
        want.append((i, begun[-1][1] if begun else mine[0][1] if mine else None))
    assert sorted((r.i, r.sk) for r in found.collect()) == sorted(want)

from datetime import date
from decimal import Decimal

import pytest
from conftest import column

from starloom.operators import orders as rules
from starloom.operators.cities import city_lookup


@pytest.fixture
def lookup(frame):
    return frame("variante string, ville string", ("tanger", "Tanger"))


def test_city_lookup_knows_spellings_and_codes(frame):
    regions = frame("nom_ville_standard string, code_ville string, _arrivee int", (" Tanger ", "TNG", 0), ("Fès", "FES", 1))
    found = {r.variante: r.ville for r in city_lookup(regions).collect()}
    assert found["tanger"] == found["TANGER"] == found["tng"] == found["TNG"] == found["tnja"] == "Tanger"
    assert found["fès"] == found["fez"] == "Fès"
    assert found["casa"] == "Casablanca"


def test_city_lookup_extras_then_later_cities_win(frame):
    regions = frame(
        "nom_ville_standard string, code_ville string, _arrivee int", ("Fes", "AA", 0), ("Autre", "AA", 1)
    )
    found = {r.variante: r.ville for r in city_lookup(regions).collect()}
    assert found["fes"] == "Fès" and found["FES"] == "Fes" and found["aa"] == "Autre"


def test_latest_line_wins(frame):
    df = frame("id_commande int, valeur string, _arrivee int", (1, "nouvelle", 9), (1, "ancienne", 2), (2, "seule", 1))
    kept = {r.id_commande: r.valeur for r in rules.latest_orders(df).collect()}
    assert kept == {1: "nouvelle", 2: "seule"}


def test_dates_are_read_and_unreadable_orders_dropped(frame):
    df = frame(
        "date_commande string, date_livraison string",
        ("2024-01-15", ""), ("pas-une-date", "2024-01-01"), ("15/01/2024", "Jan 20 2024"), ("Jan 15 2024", "junk"),
    )
    kept = rules.standardize_dates(df).collect()
    assert [r.date_commande for r in kept] == [date(2024, 1, 15)] * 3
    assert [r.date_livraison for r in kept] == [None, date(2024, 1, 20), None]


@pytest.mark.parametrize("city, expected", [("TANGER", "Tanger"), (" tanger ", "Tanger"), ("VilleXYZ", "Non renseignée"), (None, "Non renseignée")])
def test_delivery_city(frame, lookup, city, expected):
    df = frame("ville_livraison string", (city,))
    assert column(rules.standardize_delivery_city(df, lookup), "ville_livraison") == [expected]


@pytest.mark.parametrize(
    "code, expected",
    [("livré", "livré"), ("livre", "livré"), ("LIVRE", "livré"), ("DONE", "livré"), ("annulé", "annulé"),
     ("annule", "annulé"), ("KO", "annulé"), ("en_cours", "en_cours"), ("OK", "en_cours"), ("retourné", "retourné"),
     ("retourne", "retourné"), ("xyz_inconnu", "inconnu"), ("done", "inconnu"), (" KO", "inconnu"), (None, "inconnu")],
)
def test_status(frame, code, expected):
    assert column(rules.standardize_status(frame("statut string", (code,))), "statut") == [expected]


@pytest.mark.parametrize("quantity, kept", [("5", 1), ("0", 0), ("-3", 0), ("x", 0), (None, 0)])
def test_quantity(frame, quantity, kept):
    assert rules.keep_positive_quantity(frame("quantite string", (quantity,))).count() == kept


@pytest.mark.parametrize("price, kept", [("0", 0), ("100", 1), ("-1", 0), ("0.01", 1), ("", 0)])
def test_test_orders(frame, price, kept):
    assert rules.drop_test_orders(frame("prix_unitaire string", (price,))).count() == kept


@pytest.mark.parametrize("courier, expected", [(None, "-1"), ("", "-1"), ("L42", "L42"), (" ", " ")])
def test_courier(frame, courier, expected):
    assert column(rules.mark_missing_courier(frame("id_livreur string", (courier,))), "id_livreur") == [expected]


def test_amounts(frame):
    df = frame("quantite decimal(18,4), prix_unitaire decimal(18,4)", (Decimal(3), Decimal("33.33")), (Decimal(1), Decimal("0.05")))
    out = rules.add_amounts(df).collect()
    assert [(r.montant_ht, r.montant_ttc) for r in out] == [
        (Decimal("99.99"), Decimal("119.99")), (Decimal("0.05"), Decimal("0.06")),
    ]


@pytest.mark.parametrize(
    "status, ordered, delivered, expected",
    [
        ("livré", date(2024, 1, 1), date(2024, 1, 4), 3),
        ("retourné", date(2024, 1, 1), date(2024, 1, 1), 0),
        ("livré", date(2024, 1, 1), date(2024, 3, 1), 60),
        ("livré", date(2024, 1, 1), date(2024, 3, 2), None),
        ("livré", date(2024, 1, 2), date(2024, 1, 1), None),
        ("livré", date(2024, 1, 2), None, None),
        ("annulé", date(2024, 1, 1), date(2024, 1, 4), None),
    ],
)
def test_delay(frame, status, ordered, delivered, expected):
    df = frame("statut string, date_commande date, date_livraison date", (status, ordered, delivered))
    assert column(rules.add_delivery_delay(df), "delai_livraison_jours") == [expected]


def test_dedup_prunes_copies_before_the_shuffle(frame):
    df = frame("id_commande int, valeur string, _arrivee int", (1, "a", 1))
    plan = rules.latest_orders(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange") :] and "WindowGroupLimit" in plan


def test_dates_are_read_once_before_older_copies_go(spark, lookup):
    columns = "id_commande id_client id_produit date_commande quantite prix_unitaire statut ville_livraison mode_paiement id_livreur date_livraison"
    schema = ", ".join(f"{c} string" for c in columns.split()) + ", _arrivee int"
    line = lambda key, day, arrival: (key, "C", "P", day, "2", "10", "livre", "tanger", "m", "L", "", arrival)
    raw = spark.createDataFrame([line("a", "2024-01-15", 1), line("a", "pas-une-date", 2), line("b", "pas-une-date", 1), line("b", "15/01/2024", 2)], schema)
    cleaned = rules.clean_orders(raw, lookup)
    # The last line counts, also where its date is not readable.
    assert [(r.id_commande, r.date_commande) for r in cleaned.collect()] == [("b", date(2024, 1, 15))]
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window [", 1)
    assert "date_commande" in above and "as date" not in above and "as date" in below

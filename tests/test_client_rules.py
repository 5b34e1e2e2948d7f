from datetime import date
from decimal import Decimal

import pytest
from conftest import column

from starloom.operators import clients as rules
from starloom.operators.segments import client_segments
from starloom.settings import Settings

AS_OF = Settings(as_of=date(2026, 6, 1))


def test_most_recent_signup_of_an_email_wins(frame):
    df = frame(
        "id_client int, email string, date_inscription string",
        (1, "Test@Mail.com", "2020-01-01"), (2, "test@mail.com ", "01/01/2023"), (3, "autre@mail.com", "2019-01-01"),
        (4, "test@mail.com", "illisible"),
    )
    assert sorted(column(rules.latest_by_email(df), "id_client")) == [2, 3]


def test_signup_tie_goes_to_the_highest_id(frame):
    df = frame("id_client string, email string, date_inscription string", ("C1", "a@b.ma", "2020-01-01"), ("C2", "a@b.ma", "2020-01-01"))
    assert column(rules.latest_by_email(df), "id_client") == ["C2"]


@pytest.mark.parametrize(
    "code, expected",
    [("m", "m"), ("F", "f"), ("1", "m"), ("0", "f"), ("Homme", "m"), ("Femme", "f"), (" male", "m"), ("H", "m"),
     ("xyz", "inconnu"), ("", "inconnu"), (None, "inconnu")],
)
def test_sex(frame, code, expected):
    assert column(rules.standardize_sex(frame("sexe string", (code,))), "sexe") == [expected]


@pytest.mark.parametrize(
    "born, kept, band",
    [
        ("1990-01-01", True, "35-44"),
        ("2021-01-01", False, "<18"),
        ("1900-01-01", False, "<18"),
        ("pas-une-date", False, "<18"),
        (None, False, "<18"),
        ("2009-01-01", True, "<18"),
        ("2008-05-30", True, "18-24"),
        ("1950-01-01", True, "65+"),
        ("1961-01-01", True, "65+"),
        ("1962-01-01", True, "55-64"),
    ],
)
def test_birth_date(frame, born, kept, band):
    row = rules.validate_birth_date(frame("date_naissance string", (born,)), AS_OF).first()
    assert (row.date_naissance is not None, row.age is not None, row.tranche_age) == (kept, kept, band)


@pytest.mark.parametrize(
    "email, valid",
    [("test@example.com", True), ("pas-un-email", False), ("test.example.com", False), ("a@b", False),
     ("a@b.ma ", False), ("a@b.ma\n", False), ("x.y+z%1@sous.domaine.ma", True), (None, False)],
)
def test_email(frame, email, valid):
    assert column(rules.validate_email(frame("email string", (email,))), "email") == [email if valid else None]


@pytest.mark.parametrize("city, expected", [("CASA", "Casablanca"), ("VilleInexistante", "Non renseignée")])
def test_home_city(frame, city, expected):
    lookup = frame("variante string, ville string", ("casa", "Casablanca"))
    assert column(rules.standardize_home_city(frame("ville string", (city,)), lookup), "ville") == [expected]


def _orders(frame, *rows):
    return frame("id_client int, date_commande date, statut string, montant_ttc decimal(18,2)",
                 *[(c, d, s, Decimal(m)) for c, d, s, m in rows])


@pytest.mark.parametrize("amount, expected", [(20000, "Gold"), (15000, "Gold"), (7000, "Silver"), (5000, "Silver"), (1000, "Bronze")])
def test_segment(frame, amount, expected):
    out = client_segments(_orders(frame, (1, date(2024, 6, 1), "livré", amount))).collect()
    assert [(r.segment_client, r.ca_12m) for r in out] == [(expected, Decimal(amount))]


def test_undelivered_orders_do_not_count(frame):
    assert client_segments(_orders(frame, (1, date(2024, 6, 1), "annulé", 20000))).isEmpty()


def test_window_ends_at_the_newest_order_of_any_status(frame):
    rows = [(1, date(2023, 6, 2), "livré", 10000), (1, date(2020, 1, 1), "livré", 50000), (2, date(2023, 6, 1), "livré", 1),
            (3, date(2024, 6, 1), "annulé", 5)]
    out = {r.id_client: r.ca_12m for r in client_segments(_orders(frame, *rows)).collect()}
    assert out == {1: Decimal(10000)}

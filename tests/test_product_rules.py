import pytest

from starloom.operators.products import clean_products

SCHEMA = "categorie string, sous_categorie string, marque string, fournisseur string, prix_catalogue double, actif boolean"


def clean(frame, **changes):
    row = {"categorie": "Meubles", "sous_categorie": "Chaises", "marque": "MarqueX", "fournisseur": "FournA",
           "prix_catalogue": 10.0, "actif": True, **changes}
    return clean_products(frame(SCHEMA, tuple(row.values()))).first()


@pytest.mark.parametrize("text, expected", [("electronique", "Electronique"), (" ELECTRONIQUE ", "Electronique"), ("électronique", "Électronique")])
def test_category(frame, text, expected):
    assert clean(frame, categorie=text).categorie == expected


def test_names_are_trimmed(frame):
    row = clean(frame, marque=" Samsung ", fournisseur=" F A ")
    assert (row.marque, row.fournisseur) == ("Samsung", "F A")


@pytest.mark.parametrize("price, expected", [(None, -1.0), (499.99, 499.99), (0.0, 0.0)])
def test_price(frame, price, expected):
    assert float(clean(frame, prix_catalogue=price).prix_catalogue) == expected


def test_inactive_products_stay(frame):
    assert clean(frame, actif=False).actif is False

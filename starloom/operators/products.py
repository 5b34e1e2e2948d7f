"""Cleaning rules for the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import to_number
from starloom.functions.text import title_case

UNKNOWN_PRICE = -1


def clean_products(raw: DataFrame) -> DataFrame:
    """Title-case categories, trim names, mark unknown prices; inactive products stay."""
    return raw.withColumns(
        {
            "categorie": title_case(F.trim("categorie")),
            "sous_categorie": title_case(F.trim("sous_categorie")),
            "marque": F.trim("marque"),
            "fournisseur": F.trim("fournisseur"),
            "prix_catalogue": F.coalesce(to_number(F.col("prix_catalogue")), F.lit(UNKNOWN_PRICE)).cast("decimal(10,2)"),
            "actif": F.col("actif").cast("boolean"),
        }
    )

"""Cleaning rules for raw order lines. Each takes and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import parse_date
from starloom.functions.numbers import MONEY, to_number
from starloom.functions.text import map_code
from starloom.operators.cities import harmonize_city
from starloom.operators.latest import keep_latest
from starloom.schemas import ARRIVAL
from starloom.settings import (
    DELIVERED, RETURNED, STATUS_CODES, UNKNOWN_COURIER, UNKNOWN_STATUS, Settings,
)


def latest_orders(df: DataFrame) -> DataFrame:
    """Rule 1: of several lines with one order id, the last to arrive counts."""
    return keep_latest(df, ["id_commande"], [F.desc(ARRIVAL)])


def read_dates(df: DataFrame) -> DataFrame:
    """Both dates from text; null where it is not readable."""
    return df.withColumns({c: parse_date(F.col(c)) for c in ("date_commande", "date_livraison")})


def drop_undated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("date_commande").isNotNull())


def standardize_dates(df: DataFrame) -> DataFrame:
    """Rule 2: dates from three formats; lines without a readable order date go."""
    return df.transform(read_dates).transform(drop_undated)


def standardize_delivery_city(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rule 3: delivery city by the city lookup."""
    return harmonize_city(df, "ville_livraison", lookup)


def standardize_status(df: DataFrame) -> DataFrame:
    """Rule 4: eleven exact source codes to four statuses, else unknown."""
    return df.withColumn("statut", map_code(F.col("statut"), STATUS_CODES, UNKNOWN_STATUS))


def keep_positive_quantity(df: DataFrame) -> DataFrame:
    """Rule 5: quantities that are no number, zero or negative go."""
    return df.withColumn("quantite", to_number(F.col("quantite"))).filter("quantite > 0")


def drop_test_orders(df: DataFrame) -> DataFrame:
    """Rule 6: lines without a positive unit price go."""
    return df.withColumn("prix_unitaire", to_number(F.col("prix_unitaire"))).filter("prix_unitaire > 0")


def mark_missing_courier(df: DataFrame) -> DataFrame:
    """Rule 7: an empty courier id becomes the unknown courier; blanks are kept."""
    missing = F.col("id_livreur").isNull() | (F.col("id_livreur") == "")
    return df.withColumn("id_livreur", F.when(missing, UNKNOWN_COURIER).otherwise(F.col("id_livreur")))


def add_amounts(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rule 8: amounts without and with VAT, each rounded to cents."""
    net = F.round(F.col("quantite") * F.col("prix_unitaire"), 2).cast(MONEY)
    gross = F.round(F.col("montant_ht") * (F.lit(settings.vat) + 1), 2).cast(MONEY)
    return df.withColumn("montant_ht", net).withColumn("montant_ttc", gross)


def add_delivery_delay(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rule 9: days to delivery for delivered or returned lines; implausible delays are null."""
    days = F.datediff("date_livraison", "date_commande")
    plausible = F.col("statut").isin(DELIVERED, RETURNED) & days.between(0, settings.max_delay_days)
    return df.withColumn("delai_livraison_jours", F.when(plausible, days))


def clean_orders(raw: DataFrame, lookup: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All nine rules.

    Rules 3, 4, 7 and 9 look at one line and drop none, so they come before the older copies go: the lines are shuffled for that with
    dates, harmonized names and the delay in place of their text. Lines are dropped and amounts built behind it, since an older
    copy must neither stand in for a dropped line nor stop the run.
    """
    return (
        raw.transform(read_dates)
        .transform(standardize_delivery_city, lookup)
        .transform(standardize_status)
        .transform(mark_missing_courier)
        .transform(add_delivery_delay, settings)
        .transform(latest_orders)
        .transform(drop_undated)
        .transform(keep_positive_quantity)
        .transform(drop_test_orders)
        .transform(add_amounts, settings)
        .select(*raw.columns, "montant_ht", "montant_ttc", "delai_livraison_jours")
    )

"""The five dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, nth_name
from starloom.functions.text import title_case
from starloom.operators.lookup import checked_broadcast
from starloom.operators.surrogate import assign_keys
from starloom.operators.versions import highest_key
from starloom.schemas import ARRIVAL, conform
from starloom.settings import (
    DAY_NAMES, HOLIDAYS, MONTH_NAMES, OPEN_END, RAMADAN, TRANSPORTS, UNKNOWN_CITY, UNKNOWN_COURIER, ZONES, Settings,
)
from starloom.sources.calendar import days


def calendar_dimension(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """One row per day with local names and weekend, holiday and Ramadan flags."""
    day = F.col("jour_complet")
    fasting = F.lit(False)
    for first, last in RAMADAN:
        fasting = fasting | day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    columns = days(spark, settings.calendar_start, settings.calendar_end).select(
        date_key(day).alias("id_date"),
        F.dayofmonth(day).alias("jour"),
        F.month(day).alias("mois"),
        F.quarter(day).alias("trimestre"),
        F.year(day).alias("annee"),
        F.weekofyear(day).alias("semaine"),
        nth_name(DAY_NAMES, F.weekday(day) + 1).alias("libelle_jour"),
        nth_name(MONTH_NAMES, F.month(day)).alias("libelle_mois"),
        (F.weekday(day) >= 5).alias("est_weekend"),
        day.cast("string").isin(*HOLIDAYS).alias("est_ferie_maroc"),
        fasting.alias("periode_ramadan"),
    )
    return conform(columns, "dim_temps")


def _first_version(df: DataFrame, settings: Settings) -> DataFrame:
    """Columns of a version that is valid from the run date on."""
    return df.withColumns(
        {"date_debut": F.lit(settings.as_of), "date_fin": F.lit(OPEN_END), "est_actif": F.lit(True)}
    )


def product_dimension(products: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """First version of every cleaned product, keyed in catalogue order."""
    order = [F.col(ARRIVAL)] if ARRIVAL in products.columns else [F.col("id_produit")]
    keyed = assign_keys(products, order, "id_produit_sk")
    named = keyed.withColumns(
        {
            "id_produit_nk": F.col("id_produit"),
            "nom_produit": F.col("nom"),
            "prix_standard": F.col("prix_catalogue"),
        }
    )
    return conform(_first_version(named, settings), "dim_produit")


def client_dimension(
    clients: DataFrame, segments: DataFrame, regions: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """First version of every cleaned client, keyed by sign-up date.

    The segment join is large to large and unique on both sides; the region of
    the home city comes from the counted reference table.
    """
    home = checked_broadcast(
        regions.select(F.col("nom_ville_standard").alias("ville"), "region_admin"), settings.broadcast_rows
    )
    full_name = F.concat(F.trim("prenom"), F.lit(" "), F.trim("nom"))
    described = (
        clients.join(segments, "id_client", "left")
        .join(home, "ville", "left")
        .withColumns(
            {
                "segment_client": F.coalesce("segment_client", F.lit("Bronze")),
                "region_admin": F.coalesce("region_admin", F.lit(UNKNOWN_CITY)),
                "nom_complet": title_case(full_name),
                "id_client_nk": F.col("id_client"),
            }
        )
    )
    order = [F.asc_nulls_last("date_inscription"), F.col("id_client")] if "date_inscription" in clients.columns else [
        F.col("id_client")
    ]
    kept = ["id_client_nk", "nom_complet", "tranche_age", "sexe", "ville", "region_admin", "segment_client",
            "canal_acquisition", "id_client", *[c for c in ("date_inscription",) if c in clients.columns]]
    keyed = assign_keys(described.select(*kept), order, "id_client_sk")
    return conform(_first_version(keyed, settings), "dim_client")


def region_dimension(regions: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every city of the reference list, keyed in list order."""
    order = [F.col(ARRIVAL)] if ARRIVAL in regions.columns else [F.col("code_ville")]
    keyed = assign_keys(regions, order, "id_region")
    return conform(
        keyed.withColumns({"ville": F.trim("nom_ville_standard"), "pays": F.lit(settings.country)}), "dim_region"
    )


def courier_dimension(orders: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Every courier seen in the orders, in id order, and always the unknown one.

    The sources carry no courier attributes: transport and zone are placeholders
    that follow from the key. Stored couriers stay as they are; new ones follow
    the highest stored key.
    """
    unknown = orders.sparkSession.range(1).select(F.lit(UNKNOWN_COURIER).alias("id_livreur_nk"))
    seen = orders.select(F.col("id_livreur").alias("id_livreur_nk")).filter("id_livreur_nk is not null")
    found, after = seen.unionByName(unknown).distinct(), 0
    if stored is not None:
        found, after = found.join(stored, "id_livreur_nk", "left_anti"), highest_key(stored, "id_livreur")
    keyed = assign_keys(found, [F.col("id_livreur_nk")], "id_livreur", after)
    known = F.col("id_livreur_nk") != UNKNOWN_COURIER
    placeholder = lambda names: nth_name(names, F.col("id_livreur") % len(names) + 1)
    new = conform(
        keyed.withColumns(
            {
                "nom_livreur": F.when(known, F.concat(F.lit("Livreur "), "id_livreur_nk")).otherwise("Livreur inconnu"),
                "type_transport": F.when(known, placeholder(TRANSPORTS)).otherwise("Inconnu"),
                "zone_couverture": F.when(known, placeholder(ZONES)).otherwise("Inconnue"),
            }
        ),
        "dim_livreur",
    )
    return new if stored is None else stored.unionByName(new)

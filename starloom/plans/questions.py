"""The five business questions, asked of the stored reporting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.numbers import mean, percent
from starloom.operators.lookup import sized
from starloom.settings import DELIVERED, Settings


def revenue_vs_last_year(mv_ca_mensuel: DataFrame) -> DataFrame:
    """Monthly revenue by region beside the same month one year before.

    A self join, not lag: a region may lack a month.
    """
    now = mv_ca_mensuel.groupBy("annee", "mois", "libelle_mois", "region_admin").agg(F.sum("ca_ttc").alias("ca_ttc"))
    before = mv_ca_mensuel.groupBy((F.col("annee") + 1).alias("annee"), "mois", "region_admin").agg(
        F.sum("ca_ttc").alias("ca_ttc_n_moins_1")
    )
    growth = percent(F.col("ca_ttc") - F.col("ca_ttc_n_moins_1"), F.col("ca_ttc_n_moins_1"), 1)
    return (
        now.join(before, ["annee", "mois", "region_admin"], "left")
        .select(
            "annee", "mois", "libelle_mois", "region_admin", "ca_ttc", "ca_ttc_n_moins_1", growth.alias("evolution_pct")
        )
        .orderBy(F.desc("annee"), F.desc("mois"), F.desc("ca_ttc"))
    )


def top_products_in_city(mv_top_produits: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Best products per quarter in one city; ties share a rank."""
    best = mv_top_produits.filter((F.col("ville") == settings.top_city) & (F.col("rang_global") <= settings.top_k))
    return best.select(
        "annee", "trimestre", "nom_produit", "categorie", "marque", "qte_totale", "ca_total",
        "nb_clients_distincts", "rang_global",
    ).orderBy(F.desc("annee"), F.desc("trimestre"), "rang_global")


def basket_by_segment(star: dict[str, DataFrame], rows: dict[str, int], settings: Settings = Settings()) -> DataFrame:
    """Clients, sales, revenue, mean basket and revenue share of each segment.

    Sales are summed per client before the join, so it matches one row per client
    and the distinct client count becomes a row count.
    """
    per_client = (
        star["fait_ventes"]
        .filter(F.col("statut_commande") == DELIVERED)
        .groupBy("id_client")
        .agg(F.sum("montant_ttc").alias("ca"), F.count("*").alias("n"))
    )
    active = star["dim_client"].filter("est_actif").select(F.col("id_client_sk").alias("id_client"), "segment_client")
    segments = (
        per_client.join(sized(active, rows["dim_client"], settings.broadcast_rows), "id_client")
        .groupBy("segment_client")
        .agg(
            F.count("*").alias("nb_clients"),
            F.sum("n").alias("nb_commandes"),
            F.sum("ca").alias("ca_total_ttc"),
        )
    )
    overall = F.sum("ca_total_ttc").over(Window.partitionBy())  # three rows
    return segments.select(
        "segment_client", "nb_clients", "nb_commandes", "ca_total_ttc",
        F.round(F.col("ca_total_ttc") / F.col("nb_commandes"), 2).alias("panier_moyen_ttc"),
        percent(F.col("ca_total_ttc"), overall, 1).alias("part_ca_pct"),
    ).orderBy(F.desc("panier_moyen_ttc"))


def return_rate_by_class(mv_taux_retour: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The return-rate table with the alert limits beside it."""
    return mv_taux_retour.select(
        "annee", "trimestre", "categorie", "sous_categorie", "nb_livrees", "nb_retournees", "taux_retour_pct", "alerte",
        F.lit(settings.red_above).alias("seuil_rouge"),
        F.lit(settings.orange_above).alias("seuil_orange"),
    ).orderBy(F.desc("annee"), F.desc("trimestre"), F.desc("taux_retour_pct"))


def period_effect(mv_ca_mensuel: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Monthly sales of one category, on an index of its mean month outside Ramadan.

    A month that Ramadan cuts has two rows, one per flag, and the mean counts rows.
    """
    monthly = (
        mv_ca_mensuel.filter(F.col("categorie") == settings.period_category)
        .groupBy("periode_ramadan", "annee", "mois", "libelle_mois")
        .agg(F.sum("volume_vendu").alias("volume_vendu"), F.sum("ca_ttc").alias("ca"))
    )
    normal = monthly.filter(~F.col("periode_ramadan")).agg(F.sum("ca").alias("somme"), F.count("*").alias("mois_n"))
    index = F.round(F.col("ca") * F.col("mois_n") * 100 / F.nullif("somme", F.lit(0)), 1)
    return (
        monthly.crossJoin(F.broadcast(normal))  # one row
        .select(
            "annee", "mois", "libelle_mois", "periode_ramadan", F.col("ca").alias("ca_alimentation_ttc"),
            "volume_vendu", index.alias("indice_vs_moyenne"),
        )
        .orderBy("annee", "mois")
    )

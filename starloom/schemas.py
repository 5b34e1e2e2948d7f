"""Column names and types of the sources and of the star."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_COLUMNS = (
    "id_commande", "id_client", "id_produit", "date_commande", "quantite", "prix_unitaire",
    "statut", "ville_livraison", "mode_paiement", "id_livreur", "date_livraison",
)
CLIENT_COLUMNS = (
    "id_client", "nom", "prenom", "email", "date_naissance", "sexe", "ville",
    "telephone", "date_inscription", "canal_acquisition",
)
REGION_COLUMNS = (
    "code_ville", "nom_ville_standard", "province", "region_admin", "zone_geo",
    "population", "code_postal",
)
PRODUCT_JSON = (
    "produits array<struct<id_produit:string, nom:string, categorie:string, sous_categorie:string, "
    "marque:string, fournisseur:string, prix_catalogue:double, origine_pays:string, "
    "date_creation:string, actif:boolean>>"
)
PRODUCT_COLUMNS = (
    "id_produit", "nom", "categorie", "sous_categorie", "marque", "fournisseur",
    "prix_catalogue", "origine_pays", "date_creation", "actif",
)

# Every raw frame carries this column: a sortable value that grows in arrival order.
ARRIVAL = "_arrivee"

TABLES = {
    "dim_temps": (
        "id_date int, jour smallint, mois smallint, trimestre smallint, annee smallint, "
        "semaine smallint, libelle_jour string, libelle_mois string, est_weekend boolean, "
        "est_ferie_maroc boolean, periode_ramadan boolean"
    ),
    "dim_produit": (
        "id_produit_sk bigint, id_produit_nk string, nom_produit string, categorie string, "
        "sous_categorie string, marque string, fournisseur string, prix_standard decimal(10,2), "
        "origine_pays string, date_debut date, date_fin date, est_actif boolean"
    ),
    "dim_client": (
        "id_client_sk bigint, id_client_nk string, nom_complet string, tranche_age string, "
        "sexe string, ville string, region_admin string, segment_client string, "
        "canal_acquisition string, date_debut date, date_fin date, est_actif boolean"
    ),
    "dim_region": (
        "id_region bigint, ville string, province string, region_admin string, zone_geo string, pays string"
    ),
    "dim_livreur": (
        "id_livreur bigint, id_livreur_nk string, nom_livreur string, type_transport string, "
        "zone_couverture string"
    ),
    "fait_ventes": (
        "id_commande string, id_date int, id_produit bigint, id_client bigint, id_region bigint, "
        "id_livreur bigint, quantite_vendue int, montant_ht decimal(12,2), montant_ttc decimal(12,2), "
        "cout_livraison decimal(8,2), delai_livraison_jours smallint, remise_pct decimal(5,2), "
        "statut_commande string"
    ),
}
DIMENSIONS = ("dim_temps", "dim_produit", "dim_client", "dim_region", "dim_livreur")


def columns_of(table: str) -> list[str]:
    return [field.split()[0] for field in TABLES[table].split(", ")]


def conform(df: DataFrame, table: str, optional: Collection[str] = ()) -> DataFrame:
    """Cast and order df to the declared columns of a star table; optional ones may be missing."""
    fields = [field.split(maxsplit=1) for field in TABLES[table].split(", ")]
    return df.select(
        *[F.col(n).cast(kind).alias(n) for n, kind in fields if n in df.columns or n not in optional]
    )

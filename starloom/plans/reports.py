"""The stored reporting tables, computed from the star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import mean, percent
from starloom.operators.lookup import attach_by_key, checked_broadcast, hot_keys
from starloom.operators.ranking import rank_desc
from starloom.settings import DELIVERED, RETURNED, UNKNOWN_COURIER, Settings

Star = dict[str, DataFrame]
Rows = dict[str, int]


def _with_product(facts: DataFrame, star: Star, rows: Rows, columns: list[str], settings: Settings) -> DataFrame:
    """Inner join to the product dimension; unresolved fact keys may be one hot product."""
    products = star["dim_produit"].select(F.col("id_produit_sk").alias("id_produit"), *columns, F.lit(1).alias("_connu"))
    hot = None
    if rows["dim_produit"] > settings.broadcast_rows:
        hot = hot_keys(star["fait_ventes"], ["id_produit"])["id_produit"]
    joined = attach_by_key(
        facts, products, "id_produit", F.hash(*facts.columns), rows["dim_produit"], settings.broadcast_rows, hot
    )
    return joined.filter("_connu = 1").drop("_connu")


def _with_days(facts: DataFrame, star: Star, rows: Rows, columns: list[str]) -> DataFrame:
    days = star["dim_temps"].select("id_date", *columns)
    return facts.join(checked_broadcast(days, rows=rows["dim_temps"]), "id_date")


def _with_regions(facts: DataFrame, star: Star, rows: Rows, columns: list[str]) -> DataFrame:
    cities = star["dim_region"].select("id_region", *columns)
    return facts.join(checked_broadcast(cities, rows=rows["dim_region"]), "id_region")


def monthly_revenue(star: Star, rows: Rows, settings: Settings = Settings()) -> DataFrame:
    """Delivered revenue by month, period flag, city and category, with a marker of the prior year.

    Each fact row is one sale, so sales are counted as rows; only clients need a
    distinct count, which Spark first reduces to one row per group and client.
    """
    facts = star["fait_ventes"].filter(F.col("statut_commande") == DELIVERED).select(
        "id_date", "id_region", "id_produit", "id_client", "quantite_vendue", "montant_ht", "montant_ttc"
    )
    # Products first: where they are too many to broadcast, the sales are shuffled for them without the names of days and cities.
    joined = _with_product(facts, star, rows, ["categorie"], settings)
    joined = _with_days(joined, star, rows, ["annee", "mois", "trimestre", "libelle_mois", "periode_ramadan"])
    joined = _with_regions(joined, star, rows, ["region_admin", "zone_geo", "ville"])
    grouped = joined.groupBy(
        "annee", "mois", "trimestre", "libelle_mois", "periode_ramadan", "region_admin", "zone_geo", "ville", "categorie"
    ).agg(
        F.sum("montant_ttc").alias("ca_ttc"),
        F.sum("montant_ht").alias("ca_ht"),
        F.sum("quantite_vendue").alias("volume_vendu"),
        F.countDistinct("id_client").alias("nb_clients_actifs"),
        F.count("*").alias("nb_commandes"),
    )
    return grouped.withColumn("panier_moyen", mean(F.col("ca_ttc"), F.col("nb_commandes"))).withColumn(
        "annee_n1", (F.col("annee") - 1).cast("int")
    )


def top_products(star: Star, rows: Rows, settings: Settings = Settings()) -> DataFrame:
    """Products per quarter and city with their revenue rank in the category and overall."""
    facts = star["fait_ventes"].filter(F.col("statut_commande") == DELIVERED).select(
        "id_date", "id_region", "id_produit", "id_client", "quantite_vendue", "montant_ttc"
    )
    joined = _with_days(facts, star, rows, ["annee", "trimestre"])
    joined = _with_regions(joined, star, rows, ["ville"])
    place = ["annee", "trimestre", "ville", "id_produit"]
    # Shuffled by group, not by group and client: else the distinct count is shuffled a second time, with hardly fewer rows.
    totals = joined.repartition(*place).groupBy(*place).agg(
        F.sum("quantite_vendue").alias("qte_totale"),
        F.sum("montant_ttc").alias("ca_total"),
        F.countDistinct("id_client").alias("nb_clients_distincts"),
    )
    # Names join the totals, not the sales; a (quarter, city) group holds at most one row per product.
    named = _with_product(totals, star, rows, ["nom_produit", "categorie", "marque"], settings)
    # The larger groups first: the rows then lie right for the smaller ones, too.
    bound = rows["dim_produit"]
    ranked = rank_desc(
        named, ["annee", "trimestre", "ville"], "ca_total", "rang_global", bound, settings.rank_group_rows
    )
    ranked = rank_desc(
        ranked, ["annee", "trimestre", "ville", "categorie"], "ca_total", "rang_dans_categorie", bound,
        settings.rank_group_rows,
    )
    return ranked.select(
        "annee", "trimestre", "ville", F.col("id_produit").alias("id_produit_sk"), "nom_produit", "categorie", "marque",
        "qte_totale", "ca_total", "nb_clients_distincts", "rang_dans_categorie", "rang_global",
    )


def alert(rate: Column, settings: Settings) -> Column:
    return (
        F.when(rate > F.lit(settings.red_above), "rouge").when(rate > F.lit(settings.orange_above), "orange").otherwise("vert")
    )


def return_rate(star: Star, rows: Rows, settings: Settings = Settings()) -> DataFrame:
    """Returned share of the delivered or returned sales by quarter and product class, with an alert colour.

    Sales are counted per product first, so that the product join sees one row
    per quarter and product.
    """
    closed = star["fait_ventes"].filter(F.col("statut_commande").isin(DELIVERED, RETURNED))
    counted = _with_days(closed.select("id_date", "id_produit", "statut_commande"), star, rows, ["annee", "trimestre"])
    per_product = counted.groupBy("annee", "trimestre", "id_produit").agg(
        F.count_if(F.col("statut_commande") == DELIVERED).alias("livrees"),
        F.count_if(F.col("statut_commande") == RETURNED).alias("retournees"),
    )
    classed = _with_product(per_product, star, rows, ["categorie", "sous_categorie"], settings)
    totals = classed.groupBy("annee", "trimestre", "categorie", "sous_categorie").agg(
        F.sum("livrees").alias("nb_livrees"), F.sum("retournees").alias("nb_retournees")
    )
    rated = totals.withColumn(
        "taux_retour_pct", percent(F.col("nb_retournees"), F.col("nb_livrees") + F.col("nb_retournees"), 2)
    )
    return rated.withColumn("alerte", alert(F.col("taux_retour_pct"), settings))


def courier_performance(star: Star, rows: Rows, settings: Settings = Settings()) -> DataFrame:
    """Deliveries, mean delay and late share of each known courier by month.

    Counted per courier key first; the courier join then sees one row per month
    and courier.
    """
    delivered = star["fait_ventes"].filter(
        F.col("statut_commande").isin(DELIVERED, RETURNED) & F.col("delai_livraison_jours").isNotNull()
    )
    dated = _with_days(delivered.select("id_date", "id_livreur", "delai_livraison_jours"), star, rows, ["annee", "mois"])
    per_key = dated.groupBy("annee", "mois", "id_livreur").agg(
        F.count("*").alias("n"),
        F.sum("delai_livraison_jours").alias("jours"),
        F.count_if(F.col("delai_livraison_jours") > settings.late_after_days).alias("retards"),
    )
    known = (
        star["dim_livreur"]
        .filter(F.col("id_livreur_nk") != UNKNOWN_COURIER)
        .select("id_livreur", "nom_livreur", "zone_couverture", F.lit(1).alias("_connu"))
    )
    named = attach_by_key(
        per_key, known, "id_livreur", F.hash("annee", "mois"), rows["dim_livreur"], settings.broadcast_rows
    ).filter("_connu = 1")
    totals = named.groupBy("nom_livreur", "zone_couverture", "annee", "mois").agg(
        F.sum("n").alias("nb_livraisons"),
        F.sum("jours").alias("_jours"),
        F.sum("retards").alias("nb_livraisons_retard"),
    )
    return totals.select(
        "nom_livreur", "zone_couverture", "annee", "mois", "nb_livraisons",
        mean(F.col("_jours"), F.col("nb_livraisons")).alias("delai_moyen_jours"),
        "nb_livraisons_retard",
        percent(F.col("nb_livraisons_retard"), F.col("nb_livraisons"), 2).alias("taux_retard_pct"),
    )


def client_bitmaps(star: Star, rows: Rows, settings: Settings = Settings()) -> DataFrame:
    """The clients with a delivered sale, by month and city, as bitmaps over their dense keys.

    A bitmap holds 32,768 neighbouring keys. Distinct counts cannot be added up, bitmaps can: those of a quarter or a
    year follow from the stored months. The rows are shuffled to their bitmap before it is built, since one per task would
    mostly be empty.
    """
    sales = star["fait_ventes"].filter(F.col("statut_commande") == DELIVERED).select("id_date", "id_region", "id_client")
    joined = _with_regions(_with_days(sales, star, rows, ["annee", "mois", "trimestre"]), star, rows, ["ville"])
    place = ["annee", "trimestre", "mois", "ville", "tranche"]
    found = joined.withColumn("tranche", F.bitmap_bucket_number("id_client")).select(*place, "id_client").distinct()
    return found.repartition(*place).groupBy(*place).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id_client")).alias("clients"))


def clients_by_period(bitmaps: DataFrame) -> DataFrame:
    """Distinct clients by city and month, quarter and year, from the stored bitmaps alone."""

    def merged(df: DataFrame, *period: str) -> DataFrame:
        return df.groupBy(*period, "ville", "tranche").agg(F.bitmap_or_agg("clients").alias("clients"))

    def counted(df: DataFrame, kind: str, period: Column) -> DataFrame:
        sums = df.groupBy(period.cast("int").alias("periode"), "ville").agg(F.sum(F.bitmap_count("clients")).alias("nb_clients"))
        return sums.select(F.lit(kind).alias("granularite"), "periode", "ville", "nb_clients")

    quarters = merged(bitmaps, "annee", "trimestre")
    years = merged(quarters, "annee")
    return (
        counted(bitmaps, "mois", F.col("annee") * 100 + F.col("mois"))
        .unionByName(counted(quarters, "trimestre", F.col("annee") * 10 + F.col("trimestre")))
        .unionByName(counted(years, "annee", F.col("annee")))
    )


REPORTS = {
    "mv_clients": client_bitmaps,
    "mv_ca_mensuel": monthly_revenue,
    "mv_top_produits": top_products,
    "mv_taux_retour": return_rate,
    "mv_performance_livreurs": courier_performance,
}

# The part of a stored report that a row belongs to, and the attributes of the dimensions that it shows.
PART = "periode"
BY_MONTH = ("mv_clients", "mv_ca_mensuel", "mv_performance_livreurs")
SHOWN = {
    "mv_clients": {
        "dim_temps": ("id_date", "annee", "mois", "trimestre"),
        "dim_region": ("id_region", "ville"),
    },
    "mv_ca_mensuel": {
        "dim_temps": ("id_date", "annee", "mois", "trimestre", "libelle_mois", "periode_ramadan"),
        "dim_region": ("id_region", "region_admin", "zone_geo", "ville"),
        "dim_produit": ("id_produit_sk", "categorie"),
    },
    "mv_top_produits": {
        "dim_temps": ("id_date", "annee", "trimestre"),
        "dim_region": ("id_region", "ville"),
        "dim_produit": ("id_produit_sk", "nom_produit", "categorie", "marque"),
    },
    "mv_taux_retour": {
        "dim_temps": ("id_date", "annee", "trimestre"),
        "dim_produit": ("id_produit_sk", "categorie", "sous_categorie"),
    },
    "mv_performance_livreurs": {
        "dim_temps": ("id_date", "annee", "mois"),
        "dim_livreur": ("id_livreur", "id_livreur_nk", "nom_livreur", "zone_couverture"),
    },
}


def period_column(name: str) -> Column:
    """The part of a report's row: year and month as 202503, or year and quarter as 20251."""
    if name in BY_MONTH:
        return (F.col("annee") * 100 + F.col("mois")).cast("int")
    return (F.col("annee") * 10 + F.col("trimestre")).cast("int")


def period_of(name: str, month: int) -> int:
    """The part of a report that a month of sales (202503) goes into."""
    return month if name in BY_MONTH else month // 100 * 10 + (month % 100 + 2) // 3

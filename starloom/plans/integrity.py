"""Integrity report over the stored star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.numbers import percent
from starloom.settings import DELIVERED, RETURNED, STATUSES

# fact column -> (dimension, its key)
FOREIGN_KEYS = {
    "id_date": ("dim_temps", "id_date"),
    "id_produit": ("dim_produit", "id_produit_sk"),
    "id_client": ("dim_client", "id_client_sk"),
    "id_region": ("dim_region", "id_region"),
    "id_livreur": ("dim_livreur", "id_livreur"),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rows_of(df: DataFrame, name: str, value: str, labelled: dict[str, Column]) -> DataFrame:
    """One aggregation pass, turned into one output row per measure."""
    totals = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(labelled.values())])
    pairs = [F.struct(F.lit(k).alias(name), F.col(f"m{i}").alias(value)) for i, k in enumerate(labelled)]
    return totals.select(F.inline(F.array(*pairs)))


def table_counts(star: dict[str, DataFrame]) -> DataFrame:
    counts = [t.agg(F.count("*").alias("nb_lignes")).select(F.lit(n).alias("table_name"), "nb_lignes") for n, t in star.items()]
    return _union(counts).orderBy("table_name")


def orphan_keys(star: dict[str, DataFrame]) -> DataFrame:
    """Fact rows without a partner in each dimension.

    One pass turns every fact row into its five keys and counts them per key
    before anything is shuffled; the dimensions then meet distinct keys only. Both sides grow with the data.
    """
    pairs = F.array(*[F.struct(F.lit(fk).alias("cle"), F.col(fk).cast("long").alias("valeur")) for fk in FOREIGN_KEYS])
    used = star["fait_ventes"].select(F.inline(pairs)).groupBy("cle", "valeur").agg(F.count("*").alias("n"))
    known = _union(
        [
            star[dim].select(F.lit(fk).alias("cle"), F.col(pk).cast("long").alias("valeur"), F.lit(True).alias("_connu"))
            for fk, (dim, pk) in FOREIGN_KEYS.items()
        ]
    )
    missing = F.when(F.col("_connu").isNull(), F.col("n")).otherwise(0)
    label = F.concat(F.lit("fait -> "), F.element_at(F.create_map(
        *[F.lit(x) for fk, (dim, _) in FOREIGN_KEYS.items() for x in (fk, dim)]), F.col("cle")))
    return (
        used.join(known.hint("merge"), ["cle", "valeur"], "left")
        .groupBy("cle")
        .agg(F.sum(missing).alias("nb_orphelines"))
        .select(label.alias("check_name"), "nb_orphelines")
    )


def measure_anomalies(facts: DataFrame) -> DataFrame:
    return _rows_of(
        facts,
        "check_name",
        "nb_anomalies",
        {
            "Montants TTC négatifs": F.count_if(F.col("montant_ttc") < 0),
            "Quantités <= 0": F.count_if(F.col("quantite_vendue") <= 0),
            "Délais > 60 jours": F.count_if(F.col("delai_livraison_jours") > 60),
            "Statuts non standards": F.count_if(~F.col("statut_commande").isin(*STATUSES)),
        },
    )


def status_distribution(facts: DataFrame) -> DataFrame:
    counts = facts.groupBy("statut_commande").agg(F.count("*").alias("nb_commandes"))
    overall = F.sum("nb_commandes").over(Window.partitionBy())  # one row per status
    return counts.withColumn("pct", percent(F.col("nb_commandes"), overall, 1)).orderBy(F.desc("nb_commandes"))


def active_version_conflicts(star: dict[str, DataFrame]) -> DataFrame:
    """Natural keys with more than one current version, per versioned dimension."""

    def conflicts(table: str, key: str) -> DataFrame:
        versions = star[table].filter("est_actif").groupBy(key).agg(F.count("*").alias("n"))
        return versions.agg(F.count_if(F.col("n") > 1).alias("nb_anomalies")).select(
            F.lit(f"{table} : nb NK avec > 1 version active").alias("check_name"), "nb_anomalies"
        )

    return conflicts("dim_produit", "id_produit_nk").unionByName(conflicts("dim_client", "id_client_nk"))


def headline_figures(facts: DataFrame) -> DataFrame:
    """Four figures in one pass. Clients are reduced to one row each before the final count."""
    status, amount = F.col("statut_commande"), F.col("montant_ttc")
    per_client = facts.groupBy("id_client").agg(
        F.sum(F.when(status == DELIVERED, amount)).alias("ca"),
        F.count_if((status == DELIVERED) & amount.isNotNull()).alias("livrees"),
        F.count_if(status == RETURNED).alias("retours"),
        F.count_if(status.isin(DELIVERED, RETURNED)).alias("clos"),
    )
    return _rows_of(
        per_client,
        "kpi",
        "valeur",
        {
            "CA Total TTC (livrées)": F.sum("ca").cast("double"),
            "Nb clients distincts (faits)": F.count("id_client").cast("double"),
            "Taux de retour global": percent(F.sum("retours"), F.sum("clos"), 2).cast("double"),
            "Panier moyen TTC (livrées)": F.round(
                F.sum("ca") / F.nullif(F.sum("livrees"), F.lit(0)), 2
            ).cast("double"),
        },
    )


def show_figure(kpi: Column, value: Column) -> Column:
    """Display text of a headline figure."""
    money = F.concat(F.format_number(value, 2), F.lit(" MAD"))
    return (
        F.when(kpi.startswith("Taux"), F.concat(F.format_number(value, 2), F.lit("%")))
        .when(kpi.startswith("Nb"), value.cast("bigint").cast("string"))
        .otherwise(money)
    )

"""What each cleaning rule did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import parse_date
from starloom.functions.numbers import to_number
from starloom.functions.text import match_key
from starloom.operators import clients as client_rules
from starloom.operators.latest import latest_with_copies
from starloom.operators.lookup import checked_broadcast
from starloom.schemas import ARRIVAL
from starloom.settings import STATUS_CODES, UNKNOWN_CITY, UNKNOWN_SEX, Settings


def rule_audit(
    orders: DataFrame, clients: DataFrame, products: DataFrame, lookup: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """(source, regle, avant, apres, supprimees, detail) for every rule of the three sources."""
    return (
        order_rule_audit(orders, lookup)
        .unionByName(client_rule_audit(clients, lookup, settings))
        .unionByName(product_rule_audit(products))
    )


def _line(source: str, rule: str, before: str, after: str, detail: str | None = None) -> Column:
    return F.struct(
        F.lit(source).alias("source"), F.lit(rule).alias("regle"), F.col(before).alias("avant"),
        F.col(after).alias("apres"), (F.col(before) - F.col(after)).alias("supprimees"),
        (F.col(detail) if detail else F.lit(0).cast("bigint")).alias("detail"),
    )


def _raw_count() -> Column:
    return F.coalesce(F.sum("_copies"), F.lit(0)).alias("n0")


def order_rule_audit(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Counts per order rule.

    The rules only drop rows on their own columns, so one pass over the latest
    lines, each with the number of its copies, counts them all.
    """
    spellings = checked_broadcast(lookup.select(F.col("variante").alias("_cle"), F.lit(True).alias("_ville")))
    latest = (
        latest_with_copies(raw, ["id_commande"], [F.col(ARRIVAL)], "_copies")
        .withColumn("_cle", match_key(F.col("ville_livraison")))
        .join(spellings, "_cle", "left")
    )
    dated = parse_date(F.col("date_commande")).isNotNull()
    counted = to_number(F.col("quantite")) > 0
    priced = to_number(F.col("prix_unitaire")) > 0
    flags = latest.select(
        "_copies",
        dated.alias("d"),
        F.coalesce(dated & counted, F.lit(False)).alias("q"),
        F.coalesce(dated & counted & priced, F.lit(False)).alias("p"),
        F.col("_ville").isNull().alias("ville"),
        (~F.coalesce(F.col("statut"), F.lit("")).isin(*STATUS_CODES)).alias("statut"),
        F.coalesce(F.trim("id_livreur") == "", F.lit(True)).alias("livreur"),
    )
    totals = flags.agg(
        _raw_count(),
        F.count("*").alias("n1"),
        F.count_if("d").alias("n2"),
        F.count_if("q").alias("n5"),
        F.count_if("p").alias("n6"),
        F.count_if(F.col("d") & F.col("ville")).alias("villes"),
        F.count_if(F.col("d") & F.col("statut")).alias("statuts"),
        F.count_if(F.col("p") & F.col("livreur")).alias("livreurs"),
        F.count_if(~F.col("d")).alias("dates"),
    )
    source = "commandes"
    lines = F.array(
        _line(source, "R1", "n0", "n1"),
        _line(source, "R2", "n1", "n2", "dates"),
        _line(source, "R3", "n2", "n2", "villes"),
        _line(source, "R4", "n2", "n2", "statuts"),
        _line(source, "R5", "n2", "n5"),
        _line(source, "R6", "n5", "n6"),
        _line(source, "R7", "n6", "n6", "livreurs"),
    )
    return totals.select(F.inline(lines))


def client_rule_audit(raw: DataFrame, lookup: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The same for the client rules, on the cleaned clients."""
    born = parse_date(F.col("date_naissance")).isNotNull()
    normalized, newest = client_rules.by_email(raw)
    kept = latest_with_copies(normalized, ["email_norm"], newest, "_copies").withColumn("_ne", born)
    cleaned = (
        kept.transform(client_rules.standardize_sex)
        .transform(client_rules.validate_birth_date, settings)
        .transform(client_rules.validate_email)
        .transform(client_rules.standardize_home_city, lookup)
    )
    totals = cleaned.agg(
        _raw_count(),
        F.count("*").alias("n1"),
        F.count_if(F.col("sexe") == UNKNOWN_SEX).alias("sexes"),
        F.count_if(F.col("_ne") & F.col("date_naissance").isNull()).alias("ages"),
        F.count_if(F.col("email").isNull()).alias("emails"),
        F.count_if(F.col("ville") == UNKNOWN_CITY).alias("villes"),
    )
    source = "clients"
    lines = F.array(
        _line(source, "R1", "n0", "n1"),
        _line(source, "R2", "n1", "n1", "sexes"),
        _line(source, "R3", "n1", "n1", "ages"),
        _line(source, "R4", "n1", "n1", "emails"),
        _line(source, "R5", "n1", "n1", "villes"),
    )
    return totals.select(F.inline(lines))


def product_rule_audit(raw: DataFrame) -> DataFrame:
    """The product rules drop nothing: unknown prices and inactive products are counted."""
    totals = raw.agg(
        F.count("*").alias("n"),
        F.count_if(to_number(F.col("prix_catalogue")).isNull()).alias("prix"),
        F.count_if(~F.col("actif")).alias("inactifs"),
    )
    source = "produits"
    lines = F.array(
        _line(source, "R1", "n", "n"), _line(source, "R2", "n", "n", "prix"), _line(source, "R3", "n", "n", "inactifs")
    )
    return totals.select(F.inline(lines))


def fact_summary(facts: DataFrame) -> DataFrame:
    """Rows and revenue per status of the built fact."""
    return facts.groupBy("statut_commande").agg(
        F.count("*").alias("nb_lignes"), F.sum("montant_ttc").alias("montant_ttc")
    )

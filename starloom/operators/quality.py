"""Declarative table rules, evaluated together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starloom.settings import SEGMENTS, STATUSES


@dataclass(frozen=True)
class Rule:
    """One expectation on one column. Apart from not_null, nulls are not judged."""

    kind: str
    column: str
    low: int | None = None
    high: int | None = None
    values: tuple[str, ...] = ()

    def broken(self) -> Column:
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "in_set":
            return ~column.isin(*self.values)
        if self.kind == "between":
            low = F.lit(False) if self.low is None else column < self.low
            high = F.lit(False) if self.high is None else column > self.high
            return low | high
        if self.kind == "max_length":
            return F.char_length(column) > self.high
        raise ValueError(f"no row test for {self.kind}")

    def judged(self) -> Column:
        return F.count("*") if self.kind == "not_null" else F.count(self.column)


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def unique(column: str) -> Rule:
    return Rule("unique", column)


def in_set(column: str, values: Sequence[str]) -> Rule:
    return Rule("in_set", column, values=tuple(values))


def between(column: str, low: int | None = None, high: int | None = None) -> Rule:
    return Rule("between", column, low=low, high=high)


def max_length(**columns: int) -> tuple[Rule, ...]:
    return tuple(Rule("max_length", column, high=length) for column, length in columns.items())


# What a run must satisfy before its tables are trusted.
LOAD_RULES = {
    "dim_client": (not_null("id_client_nk"), unique("id_client_sk"), in_set("segment_client", SEGMENTS)),
    "dim_produit": (unique("id_produit_sk"), not_null("id_produit_nk")),
    "fait_ventes": (
        unique("id_commande"),
        not_null("id_commande"),
        between("montant_ttc", low=0),
        between("quantite_vendue", low=1),
        in_set("statut_commande", STATUSES),
    ),
}

# The smaller set asked of tables already in the warehouse.
WAREHOUSE_RULES = {
    "dim_client": (not_null("id_client_nk"), unique("id_client_sk")),
    "dim_produit": (unique("id_produit_sk"),),
    "fait_ventes": (unique("id_commande"), between("montant_ttc", low=0)),
}

# Declared constraints of the star; a replaced dimension table would not enforce them.
CONSTRAINTS = {
    "dim_temps": (
        not_null("id_date"), unique("id_date"),
        not_null("jour"), between("jour", 1, 31),
        not_null("mois"), between("mois", 1, 12),
        not_null("trimestre"), between("trimestre", 1, 4),
        not_null("annee"),
        *max_length(libelle_jour=20, libelle_mois=20),
    ),
    "dim_produit": (
        not_null("id_produit_sk"), unique("id_produit_sk"), not_null("id_produit_nk"), not_null("nom_produit"),
        not_null("date_debut"), not_null("date_fin"), not_null("est_actif"),
        *max_length(
            id_produit_nk=20, nom_produit=200, categorie=100, sous_categorie=100, marque=100, fournisseur=100,
            origine_pays=50,
        ),
    ),
    "dim_client": (
        not_null("id_client_sk"), unique("id_client_sk"), not_null("id_client_nk"),
        in_set("sexe", ("m", "f", "inconnu")), in_set("segment_client", SEGMENTS),
        not_null("date_debut"), not_null("date_fin"), not_null("est_actif"),
        *max_length(
            id_client_nk=20, nom_complet=200, tranche_age=10, ville=100, region_admin=100, segment_client=20,
            canal_acquisition=50,
        ),
    ),
    "dim_region": (
        not_null("id_region"), unique("id_region"), not_null("ville"), unique("ville"),
        *max_length(ville=100, province=100, region_admin=100, zone_geo=50, pays=50),
    ),
    "dim_livreur": (
        not_null("id_livreur"), unique("id_livreur"), not_null("id_livreur_nk"), unique("id_livreur_nk"),
        *max_length(id_livreur_nk=20, nom_livreur=100, type_transport=50, zone_couverture=100),
    ),
    "fait_ventes": (
        not_null("id_commande"), unique("id_commande"),
        not_null("id_date"), not_null("id_produit"), not_null("id_client"), not_null("id_region"),
        not_null("quantite_vendue"), between("quantite_vendue", low=1),
        not_null("montant_ht"), between("montant_ht", low=0),
        not_null("montant_ttc"), between("montant_ttc", low=0),
        in_set("statut_commande", STATUSES),
        *max_length(id_commande=30, statut_commande=20),
    ),
}

# Checked while the fact is built; a failure stops the load.
FACT_ASSERTIONS = (between("montant_ttc", low=0), between("quantite_vendue", low=1))


def check_table(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """(table_name, regle, colonne, evalues, echecs, succes), one row per rule.

    All row rules share one aggregation; each uniqueness rule adds one count per
    value, combined before the shuffle.
    """
    row_rules = [r for r in rules if r.kind != "unique"]
    parts = [_check_unique(df, r) for r in rules if r.kind == "unique"]
    if row_rules:
        totals = df.agg(
            *[r.judged().alias(f"n{i}") for i, r in enumerate(row_rules)],
            *[F.count_if(r.broken()).alias(f"e{i}") for i, r in enumerate(row_rules)],
        )
        lines = [
            F.struct(
                F.lit(r.kind).alias("regle"), F.lit(r.column).alias("colonne"),
                F.col(f"n{i}").alias("evalues"), F.col(f"e{i}").alias("echecs"),
            )
            for i, r in enumerate(row_rules)
        ]
        parts.append(totals.select(F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(table).alias("table_name"), "regle", "colonne", "evalues", "echecs", (F.col("echecs") == 0).alias("succes")
    )


def _check_unique(df: DataFrame, rule: Rule) -> DataFrame:
    counts = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evalues"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("echecs"),
    ).select(F.lit("unique").alias("regle"), F.lit(rule.column).alias("colonne"), "evalues", "echecs")


def check_star(star: dict[str, DataFrame], rules: dict[str, Sequence[Rule]], skip_empty: bool = False) -> DataFrame:
    """All rules of all tables present in star."""
    present = [t for t in rules if t in star and not (skip_empty and star[t].isEmpty())]
    if not present:
        raise ValueError("no table to check")
    return reduce(DataFrame.unionByName, [check_table(star[t], t, rules[t]) for t in present])


def table_scores(report: DataFrame) -> DataFrame:
    """Rules passed per table."""
    return report.groupBy("table_name").agg(
        F.count_if("succes").alias("regles_ok"), F.count("*").alias("regles"), F.every("succes").alias("succes")
    )


class QualityError(RuntimeError):
    """A rule failed on a built table."""


def require(report: DataFrame) -> list[Row]:
    """Read the report, one row per rule, and raise if any rule failed."""
    lines = report.collect()
    failed = [r for r in lines if not r.succes]
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.colonne} {r.regle}: {r.echecs} of {r.evalues}" for r in failed))
    return lines

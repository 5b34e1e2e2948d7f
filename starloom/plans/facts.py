"""The sales fact: natural keys to surrogate keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.operators.asof import attach_as_of
from starloom.operators.lookup import attach_by_key, hot_keys
from starloom.schemas import conform
from starloom.settings import UNKNOWN_COURIER, Settings


@dataclass(frozen=True)
class KeyMap:
    """How one foreign key of the fact is found."""

    dimension: str
    order_column: str
    natural: str
    surrogate: str
    output: str


PRODUCT = KeyMap("dim_produit", "id_produit", "id_produit_nk", "id_produit_sk", "id_produit")
CLIENT = KeyMap("dim_client", "id_client", "id_client_nk", "id_client_sk", "id_client")
REGION = KeyMap("dim_region", "ville_livraison", "ville", "id_region", "id_region")
COURIER = KeyMap("dim_livreur", "id_livreur", "id_livreur_nk", "id_livreur", "id_livreur")
KEY_MAPS = (PRODUCT, CLIENT, REGION, COURIER)
# What the star reads of a cleaned order line.
ORDER_COLUMNS = (
    "id_commande", "date_commande", "id_produit", "id_client", "ville_livraison", "id_livreur", "quantite", "montant_ht", "montant_ttc",
    "delai_livraison_jours", "statut",
)


def resolve_key(
    orders: DataFrame,
    dimension: DataFrame,
    key: KeyMap,
    rows: int,
    settings: Settings = Settings(),
    hot: list | None = None,
) -> DataFrame:
    """Add _sk_<output>: the surrogate key, or null where the natural key is not known.

    rows is the counted size of the dimension. In a dimension with history the version that was valid on
    the order's day resolves, also for late orders; an order older than its key's first version gets that one. Of
    several rows with one natural key (and start) the last counts, so no order line doubles.
    """
    surrogate = f"_sk_{key.output}"
    dated = [c for c in ("date_debut",) if c in dimension.columns]
    named = dimension.select(F.col(key.natural).alias(key.order_column), F.col(key.surrogate).alias(surrogate), *dated)
    spread_by = F.col("id_commande")
    if dated:
        return attach_as_of(
            orders, named, key.order_column, F.col("date_commande"), "date_debut", [surrogate], spread_by, rows,
            settings.broadcast_rows, hot,
        )
    lookup = named.groupBy(key.order_column).agg(F.max(surrogate).alias(surrogate))
    return attach_by_key(orders, lookup, key.order_column, spread_by, rows, settings.broadcast_rows, hot)


def fallback_key(key: KeyMap, dimension: DataFrame, settings: Settings):
    """What an unresolved key becomes: the unknown courier, elsewhere a set key."""
    if key is COURIER:
        unknown = dimension.filter(F.col(key.natural) == UNKNOWN_COURIER)
        return unknown.agg(F.first(key.surrogate)).scalar()
    return F.lit(settings.unresolved_sk)


def sales_fact(
    orders: DataFrame,
    dimensions: dict[str, DataFrame],
    rows: dict[str, int],
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per cleaned order line with its keys and measures.

    Hot natural keys are looked for once, in the cleaned orders, for all
    dimensions that are too large to broadcast. These come last: the lines are shuffled
    for them with the keys found so far in place of names.
    """
    large = [k.order_column for k in KEY_MAPS if rows[k.dimension] > settings.broadcast_rows]
    hot = hot_keys(orders, large)
    resolved = orders.select(*[F.col(c).cast("int").alias("quantite_vendue") if c == "quantite" else c for c in ORDER_COLUMNS])
    for key in sorted(KEY_MAPS, key=lambda k: rows[k.dimension] > settings.broadcast_rows):
        resolved = resolve_key(resolved, dimensions[key.dimension], key, rows[key.dimension], settings, hot.get(key.order_column))
    keys = {
        key.output: F.coalesce(
            F.col(f"_sk_{key.output}"), fallback_key(key, dimensions[key.dimension], settings)
        )
        for key in KEY_MAPS
    }
    facts = resolved.withColumns(
        {
            **keys,
            "id_date": date_key(F.col("date_commande")),
            "cout_livraison": F.lit(None),
            "remise_pct": F.lit(0),
            "statut_commande": F.col("statut"),
        }
    )
    return conform(facts, "fait_ventes")

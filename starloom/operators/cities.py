"""City lookup and harmonization."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import match_key, title_case
from starloom.operators.latest import keep_latest
from starloom.operators.lookup import checked_broadcast
from starloom.schemas import ARRIVAL
from starloom.settings import CITY_EXTRAS, UNKNOWN_CITY


def city_lookup(regions: DataFrame, extras: Mapping[str, str] = CITY_EXTRAS) -> DataFrame:
    """(variante, ville): spellings and codes of each city, then the extras, which win.

    Of two cities claiming one spelling, the one listed later wins.
    """
    name, code = F.trim("nom_ville_standard"), F.trim("code_ville")
    spellings = F.array_distinct(
        F.array(name, F.lower(name), F.upper(name), title_case(name), F.lower(code), F.upper(code))
    )
    order = F.col(ARRIVAL) if ARRIVAL in regions.columns else F.monotonically_increasing_id()
    claims = regions.select(
        name.alias("ville"), order.alias("_ordre"), F.explode(spellings).alias("variante")
    )
    listed = keep_latest(claims, ["variante"], [F.desc("_ordre")]).select("variante", "ville")
    pairs = F.create_map(*[F.lit(x) for pair in extras.items() for x in pair])
    fixed = regions.sparkSession.range(1).select(F.explode(pairs).alias("variante", "ville"))
    return listed.join(F.broadcast(fixed), "variante", "left_anti").unionByName(fixed)


def harmonize_city(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Replace a free-text city by its standard name, or by the unknown mark.

    The lookup holds a few spellings per known city; its size is counted
    before it is broadcast. Lookups are lower-cased first, so only lower-case
    spellings can match.
    """
    reachable = lookup.filter(F.col("variante") == F.lower("variante")).select(
        F.col("variante").alias("_cle"), F.col("ville").alias("_ville")
    )
    standard = F.coalesce("_ville", F.lit(UNKNOWN_CITY))
    matched = df.withColumn("_cle", match_key(F.col(column))).join(checked_broadcast(reachable), "_cle", "left")
    return matched.withColumn(column, standard).drop("_cle", "_ville")

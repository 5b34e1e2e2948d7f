"""The version of a dimension row that was valid on a fact's day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.lookup import hot_keys

# Into so many parts the facts of a hot key are cut; its versions go to each of them.
PARTS = 64


def attach_as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    day: Column,
    start: str,
    values: Sequence[str],
    spread_by: Column,
    version_rows: int,
    limit: int,
    hot: list | None = None,
) -> DataFrame:
    """facts with the values of the last version of their key that starts on their day or before.

    A day before the first version, or a missing one, gets the first: nothing older is known of the key. Of
    versions that start on the same day the one with the greatest values counts, the first value first.
    Facts without a key, or with one that has no version, get nulls. No fact is dropped or doubled.

    At most `limit` counted versions are broadcast, as one sorted array per key. Beyond that facts and
    versions are shuffled by key, sorted by day and merged in one pass, whatever the number of versions of a key. Facts
    of hot keys are cut into PARTS, and only the versions of these few keys are copied to the parts; facts without
    a key are spread.
    """
    known = versions.filter(F.col(key).isNotNull()).groupBy(key, F.col(start).alias("_debut")).agg(F.max(F.struct(*values)).alias("_valeurs"))
    if version_rows <= limit:
        found = _from_arrays(facts, known, key, day)
    else:
        found = _merged(facts, known, key, day, spread_by, hot_keys(facts, [key])[key] if hot is None else hot)
    return found.select(*facts.columns, *[F.col(f"_valeurs.{c}").alias(c) for c in values])


def _from_arrays(facts: DataFrame, known: DataFrame, key: str, day: Column) -> DataFrame:
    sorted_ = F.array_sort(F.collect_list(F.struct("_debut", "_valeurs")))
    lookup = known.groupBy(key).agg(sorted_.alias("_versions"))
    begun = F.filter("_versions", lambda v: v["_debut"] <= F.col("_jour"))
    joined = facts.withColumn("_jour", day).join(F.broadcast(lookup), key, "left")
    chosen = F.coalesce(F.try_element_at(begun, F.lit(-1)), F.try_element_at("_versions", F.lit(1)))
    return joined.withColumn("_valeurs", chosen["_valeurs"])


def _merged(facts: DataFrame, known: DataFrame, key: str, day: Column, spread_by: Column, hot: list) -> DataFrame:
    # Of a key's versions the first holds for all days before it, too.
    in_order = Window.partitionBy(key).orderBy("_debut")
    bounds = known.withColumn("_jour", F.when(F.lag("_debut").over(in_order).isNotNull(), F.col("_debut")))
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    bounds = bounds.withColumn("_part", F.explode(copies)).select(key, "_part", "_jour", F.lit(False).alias("_fait"), "_valeurs")
    part = F.when(is_hot | F.col(key).isNull(), F.pmod(F.hash(spread_by), F.lit(PARTS))).otherwise(0)
    rows = facts.select("*", part.alias("_part"), day.alias("_jour"), F.lit(True).alias("_fait"))
    merged = rows.unionByName(bounds, allowMissingColumns=True)
    begun = Window.partitionBy(key, "_part").orderBy(F.asc_nulls_first("_jour"), "_fait")
    begun = begun.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return merged.withColumn("_valeurs", F.last("_valeurs", ignorenulls=True).over(begun)).filter("_fait")

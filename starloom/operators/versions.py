"""Type 2 history: close changed versions, open new ones."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.latest import keep_latest
from starloom.operators.surrogate import assign_keys
from starloom.session import stage
from starloom.settings import OPEN_END


def one_per_key(df: DataFrame, sk: str, nk: str) -> DataFrame:
    """The row with the highest sk of every natural key; a row without one could not be recognized later."""
    return keep_latest(df.filter(F.col(nk).isNotNull()), [nk], [F.desc(sk)])


def extend_keys(current: DataFrame, incoming: DataFrame, sk: str, nk: str) -> DataFrame:
    """A dimension without history after a run in which incoming holds the present rows.

    Known natural keys keep their key and take the incoming attributes, new ones
    follow the highest key in the order of incoming's own keys, missing ones stay.
    """
    state = one_per_key(incoming, sk, nk)
    columns = current.columns
    known = current.select(sk, nk).join(state.drop(sk), nk).select(columns)
    missing = current.join(state.select(nk), nk, "left_anti").select(columns)
    unseen = state.join(current.select(nk), nk, "left_anti").withColumnRenamed(sk, "_ordre")
    numbered = assign_keys(unseen, [F.col("_ordre")], sk, after=highest_key(current, sk))
    return missing.unionByName(known).unionByName(numbered.select(columns))


def highest_key(current: DataFrame, sk: str) -> Column:
    return current.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()


def merge_versions(
    current: DataFrame,
    incoming: DataFrame,
    sk: str,
    nk: str,
    tracked: Sequence[str],
    as_of: date,
    next_run: date | None = None,
) -> DataFrame:
    """The dimension after a run in which incoming holds the state of each natural key on the day as_of.

    Only changes of tracked columns open a version. The version that covers as_of ends the day before it, and
    a new one starts on it; a version that starts on as_of itself is changed in place, so none ends before it
    starts. New keys: a first version. Keys that are unchanged or missing stay. The other columns of incoming
    are brought up to date in the open version, unless a later run has been stored. New versions are numbered
    after the highest key, by natural key and start.

    as_of may lie before what is stored (a back-dated run). What later runs saw then stays: the new version ends
    before the next one, and if that has the same tracked values, it starts on as_of instead. A version that
    covers as_of and next_run too, the day of the first run after as_of, holds again from that day on. Without
    next_run it is the first start of a version after as_of; pass it where a run may have changed nothing.

    incoming holds each natural key once, and none that is null (see one_per_key).
    """
    columns = current.columns
    carried = [c for c in incoming.columns if c in columns and c not in (sk, nk, "date_debut", "date_fin", "est_actif")]
    state = incoming.select(F.col(nk).alias("_nk"), *[F.col(c).alias(f"_neuf_{c}") for c in carried], F.lit(True).alias("_present"))
    day = F.lit(as_of)
    if next_run is None:
        # One value: the later runs' first day.
        next_run = current.filter(F.col("date_debut") > day).agg(F.min("date_debut")).first()[0]
    later = F.lit(next_run).cast("date")

    differs: Column = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_neuf_{c}"))
    timeline = Window.partitionBy(nk).orderBy("date_debut", sk)
    whole = Window.partitionBy(nk)
    starts = F.col("date_debut")
    matched = current.filter(F.col(nk).isNotNull()).join(state, F.col(nk) == F.col("_nk"), "full_outer")
    matched = matched.withColumn(nk, F.coalesce(nk, "_nk")).drop("_nk")

    def at_key(condition: Column) -> Column:
        """Whether the condition holds for any version of the key."""
        return F.max(F.coalesce(condition, F.lit(False))).over(whole)

    covers = (starts <= day) & (F.col("date_fin") >= day)
    placed = matched.withColumns(
        {
            "_nouveau": F.col(sk).isNull(),
            "_differe": differs & F.col("_present").isNotNull(),
            "_couvre": F.coalesce(covers, F.lit(False)),
            "_tient": F.coalesce(covers & (F.col("date_fin") >= later), F.lit(False)),
            "_suit": F.coalesce((starts > day) & F.coalesce(F.lag("date_debut").over(timeline) <= day, F.lit(True)), F.lit(False)),
        }
    ).withColumns(
        {
            # Something else was valid on as_of than what is stored.
            "_change": F.col("_present").isNotNull() & ~at_key(F.col("_couvre") & (~F.col("_differe") | (starts == day))),
            "_reprend": at_key(F.col("_tient")),
            "_avance": at_key(F.col("_suit") & ~F.col("_differe")) & ~at_key(F.col("_tient")),
            "_suivante": F.min(F.when(F.col("_suit"), starts)).over(whole),
        }
    )
    judged = stage(placed, f"{sk}-merge")

    ended = F.col("_change") & F.col("_couvre")
    in_place = F.col("_couvre") & (starts == day) & F.col("_differe")
    cut = in_place & F.col("_tient")
    fresh = F.col("est_actif") & F.col("_present").isNotNull() & ~ended & later.isNull()
    kept = judged.filter("not _nouveau").withColumns(
        {
            "date_debut": F.when(F.col("_change") & F.col("_avance") & F.col("_suit"), day).otherwise(starts),
            "date_fin": F.when(ended, F.date_sub(day, 1)).when(cut, F.date_sub(later, 1)).otherwise(F.col("date_fin")),
            "est_actif": F.col("est_actif") & ~ended & ~cut,
            **{c: F.when(fresh | in_place, F.col(f"_neuf_{c}")).otherwise(F.col(c)) for c in carried},
        }
    )
    # Several open versions of one key, stored by a first load, are followed by one.
    followed = judged.filter("_nouveau or (_change and not _avance)").dropDuplicates([nk])
    until = F.when(F.col("_reprend"), F.date_sub(later, 1)).otherwise(F.coalesce(F.date_sub("_suivante", 1), F.lit(OPEN_END)))
    opened = followed.select(
        nk, *[F.col(f"_neuf_{c}").alias(c) for c in carried], day.alias("date_debut"), until.alias("date_fin"),
        (until == F.lit(OPEN_END)).alias("est_actif"),
    )
    resumed = judged.filter((F.col("_change") | in_place) & F.col("_tient")).dropDuplicates([nk])
    resumed = resumed.select(nk, *carried, later.alias("date_debut"), "date_fin", "est_actif")
    numbered = assign_keys(opened.unionByName(resumed), [F.col(nk), F.col("date_debut")], sk, after=highest_key(current, sk))
    unnamed = current.filter(F.col(nk).isNull())
    # Columns that incoming lacks are unknown in new versions.
    return kept.select(columns).unionByName(unnamed).unionByName(numbered, allowMissingColumns=True).select(columns)

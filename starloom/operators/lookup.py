"""Left joins to a table that is unique on the key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.settings import Settings

# A key holding more than this share of the rows is routed around the shuffle.
HOT_SHARE = 0.001
SPREAD = 4096


def checked_broadcast(df: DataFrame, limit: int = Settings.broadcast_rows, rows: int | None = None) -> DataFrame:
    """Mark df for broadcast if its rows, known or counted up to just above the limit, prove it small."""
    size = df.limit(limit + 1).count() if rows is None else rows
    return F.broadcast(df) if size <= limit else df


def sized(df: DataFrame, rows: int, limit: int = Settings.broadcast_rows) -> DataFrame:
    """Mark df for broadcast if its counted rows prove it small, and for a shuffle if they do not.

    Left alone, Spark goes by the bytes of the files: columns that compress well, such as dense keys and repeated
    names, would pass through the driver however many rows they have.
    """
    return F.broadcast(df) if rows <= limit else df.hint("merge")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[str, list]:
    """For each key column, all values above the given share of rows, and maybe a few below it.

    freqItems needs one pass for all columns and keeps at most 1/share values of each.
    """
    found = df.stat.freqItems(list(keys), share).first() if keys else ()
    return {key: [v for v in values or [] if v is not None] for key, values in zip(keys, found)}


def attach_by_key(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Column,
    lookup_rows: int,
    limit: int = Settings.broadcast_rows,
    hot: list | None = None,
) -> DataFrame:
    """facts LEFT JOIN lookup USING (key); lookup holds each key once.

    A lookup of at most `limit` counted rows is broadcast. Beyond that the join
    shuffles, except for hot keys: their few lookup rows (at most 1/HOT_SHARE)
    are broadcast, and their fact rows, like those without a key, are spread over
    the shuffle by a hash of spread_by, where they meet no partner. One pass, and
    no row is copied or dropped. Callers that know a cheaper place to look for
    the hot keys than facts pass them in; a key missing there only costs balance.
    """
    if lookup_rows <= limit:
        return facts.join(F.broadcast(lookup), key, "left")
    if hot is None:
        hot = hot_keys(facts, [key])[key]
    values = [c for c in lookup.columns if c != key]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    few = lookup.filter(is_hot).select(key, *[F.col(c).alias(f"_chaud_{c}") for c in values])
    # Always 0, but not a literal: Spark would fold a literal out of the join keys, and with it the spreading.
    cold = lookup.withColumn("_sel", F.pmod(F.hash(key), F.lit(1)))
    aside = F.col(key).isNull() | is_hot
    salt = F.when(aside, F.pmod(F.hash(spread_by), F.lit(SPREAD)) + 1).otherwise(0)
    routed = facts.join(F.broadcast(few), key, "left").withColumn("_sel", salt)
    joined = routed.join(sized(cold, lookup_rows, limit), [key, "_sel"], "left")
    found = [F.coalesce(F.col(f"_chaud_{c}"), F.col(c)).alias(c) for c in values]
    return joined.select(*facts.columns, *found)

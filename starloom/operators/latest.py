"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first under newest_first.

    The row_number = 1 filter lets Spark drop older copies on the map side
    (WindowGroupLimit), so each map task ships at most one row per key and a
    key with very many copies does not gather in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rang", rank).filter("_rang = 1").drop("_rang")


def latest_with_copies(df: DataFrame, keys: Sequence[str], newest: Sequence[Column], copies: str) -> DataFrame:
    """The row per key with the greatest newest values (null is least), and how many rows the key has.

    One aggregation, combined before the shuffle, gives both.
    """
    row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*newest)).alias("_ligne")
    return df.groupBy(*keys).agg(row, F.count("*").alias(copies)).select("_ligne.*", copies)

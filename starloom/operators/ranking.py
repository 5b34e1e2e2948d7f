"""RANK() within groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.settings import Settings


def rank_desc(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    name: str,
    group_rows: int,
    limit: int = Settings.rank_group_rows,
) -> DataFrame:
    """Add name = RANK() OVER (PARTITION BY group ORDER BY value DESC).

    group_rows is an upper bound of the rows in one group. Within the limit one
    window does it. Above it, each group is cut into bands of similar value by a
    fixed rising function of the value; a row's rank is its rank in its band plus
    the number of rows in the higher bands. Equal values share a band, so ties
    rank as in the plain window.
    """
    if group_rows <= limit:
        return df.withColumn(name, F.rank().over(Window.partitionBy(*group).orderBy(F.desc(value))).cast("int"))
    banded = df.withColumn("_bande", _band(F.col(value)))
    sizes = banded.groupBy(*group, "_bande").agg(F.count("*").alias("_n"))
    higher = (
        Window.partitionBy(*group).orderBy(F.desc("_bande")).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(*group, "_bande", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_avant"))
    local = F.rank().over(Window.partitionBy(*group, "_bande").orderBy(F.desc(value)))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*group, "_bande")]
    ranked = banded.withColumn("_local", local).alias("r").join(offsets.alias("o"), same)
    return ranked.select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col("_local") + F.col("_avant")).cast("int").alias(name)
    )


def _band(value: Column) -> Column:
    """About 46 bands per power of ten, rising with the value on both sides of zero."""
    v = value.cast("double")
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * 20)

"""Dense integer keys 1..n in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import stage

# monotonically_increasing_id puts the partition above bit 33 and the row below it.
_ROW_BITS = 33


def assign_keys(df: DataFrame, order: Sequence[Column], name: str, after: int | Column = 0) -> DataFrame:
    """Number the rows after+1, after+2, ... in the given total order.

    A global row_number would pull all rows into one task. Here the rows are
    range-sorted over all tasks and written once, with their partition and their
    place in it; the per-partition counts, one row each, give the offsets.
    The write also fixes the partitioning, which a recomputation could change.
    """
    placed = stage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), name)
    slice_of = F.shiftright(F.col("_place"), _ROW_BITS).alias("_tranche")
    sizes = placed.groupBy(slice_of).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_tranche").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_tranche", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_avant"))
    place_in_slice = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    key = F.col("_avant") + place_in_slice + 1 + after
    return (
        placed.withColumn("_tranche", slice_of)
        .join(F.broadcast(offsets), "_tranche")
        .withColumn(name, key.cast("long"))
        .drop("_place", "_tranche", "_avant")
    )

"""Generated source: one row per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from start to end, both included."""
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("jour_complet"))

"""Customer segments by trailing revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.settings import DELIVERED, Settings


def client_segments(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(id_client, segment_client, ca_12m) over the window that ends at the newest order of any status.

    Clients without a delivered order in the window do not appear.
    """
    newest = orders.agg(F.max("date_commande")).scalar()
    recent = orders.filter(
        (F.col("date_commande") >= F.date_sub(newest, settings.revenue_window_days)) & (F.col("statut") == DELIVERED)
    )
    revenue = recent.groupBy("id_client").agg(F.sum("montant_ttc").alias("ca_12m"))
    return revenue.select("id_client", segment(F.col("ca_12m"), settings).alias("segment_client"), "ca_12m")


def segment(revenue: Column, settings: Settings) -> Column:
    return (
        F.when(revenue >= F.lit(settings.gold_from), "Gold")
        .when(revenue >= F.lit(settings.silver_from), "Silver")
        .otherwise("Bronze")
    )

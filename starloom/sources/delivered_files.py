"""Source set over the four delivered files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starloom.sources import files


@dataclass
class DeliveredFiles:
    spark: SparkSession
    orders_csv: str
    clients_csv: str
    products_json: str
    regions_csv: str
    multi_line: bool = False  # CSV cells may hold line breaks

    def orders(self) -> DataFrame:
        return files.read_orders(self.spark, self.orders_csv, multi_line=self.multi_line)

    def clients(self) -> DataFrame:
        return files.read_clients(self.spark, self.clients_csv, multi_line=self.multi_line)

    def products(self) -> DataFrame:
        return files.read_products(self.spark, self.products_json)

    def regions(self) -> DataFrame:
        return files.read_regions(self.spark, self.regions_csv)

"""Incremental fact load from files as they arrive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from starloom import schemas
from starloom.operators.orders import clean_orders
from starloom.plans.facts import sales_fact
from starloom.settings import Settings
from starloom.sinks.upsert import upsert_facts
from starloom.sources.files import with_arrival


def load_arrivals(
    arrivals: DataFrame,
    to_facts: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    loaded_at: datetime,
) -> None:
    """Take every file not seen before through to_facts into the stored fact, then stop.

    The checkpoint remembers the files that are done. A batch that is replayed
    after a crash upserts the same keys again, which changes nothing.
    """

    def load(batch: DataFrame, _: int) -> None:
        upsert_facts(to_facts(batch), target, loaded_at)

    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_facts(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Files of ready fact rows as a stream."""
    reader = spark.readStream.schema(schemas.TABLES["fait_ventes"])
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def raw_orders_to_facts(
    cities: DataFrame,
    dimensions: dict[str, DataFrame],
    rows: dict[str, int],
    settings: Settings = Settings(),
) -> Callable[[DataFrame], DataFrame]:
    """What turns a batch of raw order text into fact rows: last line per order, cleaned and keyed."""

    def to_facts(batch: DataFrame) -> DataFrame:
        cleaned = clean_orders(with_arrival(batch), cities, settings)
        return sales_fact(cleaned, dimensions, rows, settings)

    return to_facts

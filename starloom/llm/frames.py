"""Helpers all operators of this folder share: Arrow batches, checked broadcasts, stable samples, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import stage

BATCH_ROWS, BATCH_BYTES = "1000", "8m"
# A key set up to this many rows of two longs (32 MB) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 2_000_000


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors once per application, and limit what one Arrow batch holds.

    Executors get the code from the driver as a Python file of the application.
    With the limits, used where the session has none of its own, a Python worker
    needs memory for a few megabytes of text at a time, whatever the size of a partition.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="starloom-code-"), "starloom.zip")
        with zipfile.ZipFile(target, "w") as bundle:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
        _shipped.add(context.applicationId)
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply work to each Arrow batch of df; the batches of a partition follow each other in one worker.

    After its last batch the worker, which waits for the next task, gives the memory of the batches back.
    """
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column; null counts as empty."""
    return [value or "" for value in batch.column(column).to_pylist()]


def keep_ids(df: DataFrame, ids: DataFrame, key: str, keep: bool = True, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of df whose key is (or, with keep=False, is not) among the distinct ids.

    The ids are counted first: up to limit rows they are broadcast, so that wide
    rows stay where they are; beyond it both sides are shuffled. Rows without a
    key are never among the ids.
    """
    marks = stage(ids.select(F.col(key).alias("_among")).filter("_among is not null").distinct(), "ids")
    if marks.limit(limit + 1).count() <= limit:
        marks = F.broadcast(marks)
    return df.join(marks, df[key] == marks["_among"], "left_semi" if keep else "left_anti")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components: (node, component) for every node of links, component being the smallest node.

    Each round every node takes the smallest label among itself and its
    neighbours, then the label of that label (pointer jumping), so that long
    chains shrink by more than half a round. The labels of each round are
    staged; the loop ends when no label changes. No link or label is collected.
    A node with very many links is summed before the shuffle.
    """
    both = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    edges = stage(both.union(both.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        lowered = labels.join(near.agg(F.min("component").alias("_near")), "node")
        lowered = lowered.select("node", F.col("component").alias("_was"), F.least("component", "_near").alias("_via"))
        jump = labels.select(F.col("node").alias("_via"), F.col("component").alias("_jump"))
        moved = lowered.join(jump, "_via").select("node", F.least("_via", "_jump").alias("component"), "_was")
        moved = stage(moved, "labels")
        changed = moved.filter("component <> _was").limit(1).count()
        labels = moved.drop("_was")
        if not changed:
            return labels

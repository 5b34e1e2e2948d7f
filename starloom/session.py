"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


# The JVM never compiles a method above 8000 bytes: a stage whose generated code is longer is cut into smaller methods instead.
HUGE_METHOD, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# A task that sorts so many wide rows, or what so many shuffled bytes unpack to, keeps them in memory.
ROWS_PER_TASK, SHUFFLED_PER_TASK = 250_000, "16m"
CODEC, STORED_CODEC = "spark.sql.parquet.compression.codec", "zstd"
# Hardly a value of it repeats: a writer would fill a dictionary first and then give it up.
_DISTINCT = "id_commande"


def get_session(app: str = "starloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; cluster settings win where they are given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        HUGE_METHOD: COMPILED_BYTES,
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_to_rows(spark: SparkSession, rows: int) -> None:
    """Settings of a running session for tables of so many rows.

    Shuffles start with enough partitions that none has to spill; adaptive execution merges those that stay small.
    A greater number stays, and so do sizes that the user has set.
    """
    for key, value in {HUGE_METHOD: COMPILED_BYTES, ADVISORY: SHUFFLED_PER_TASK}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    wanted = -(-rows // ROWS_PER_TASK)
    if wanted > int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_PARTITIONS, str(wanted))


def scratch_root(spark: SparkSession) -> str:
    """Folder for staged tables: below spark.checkpoint.dir, which every executor can reach.

    Only a local master may fall back to a folder of its own, since there the
    driver and the executors share one disk.
    """
    context = spark.sparkContext
    shared = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="starloom-")
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


def parquet_writer(df: DataFrame) -> DataFrameWriter:
    """A writer of staged and stored tables: Zstandard, unless the session names a codec."""
    writer = df.write.option(f"parquet.enable.dictionary#{_DISTINCT}", "false")
    return writer if df.sparkSession.conf.get(CODEC, None) else writer.option("compression", STORED_CODEC)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet and return the written table.

    Cuts the lineage: later jobs reread files that outlive any executor, and
    values that depend on the partitioning are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    parquet_writer(df).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder of any file system Spark reaches; none if it does not exist."""
    system, place = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged or retired files."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def side_by_side(spark: SparkSession, work: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent jobs at the same time, so that small ones share the executors."""
    with ThreadPoolExecutor(max_workers=max(1, len(work))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in work.items()}
        return {name: future.result() for name, future in started.items()}

"""Loads that readers see whole or not at all: new folders, and a manifest that is written last.

Every load writes what it changes into folders of its own (`<table>/generation=<token>`), never into one that a
reader may have open. One row of the manifest then names, for every table, the generation that holds it; for tables
in parts (the sales by month, reports by period) that of every part. That row is a single file, so it appears at
once. Readers follow the row with the highest number. A load that dies before it leaves folders nobody reads; it
is simply run again, and retire() clears what no kept generation names. One load at a time may run on a root; of two that started from
the same generation the second to publish is refused.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from starloom.session import children, parquet_writer, remove

TOKEN = "generation"
_MANIFEST = "manifestes"
_FIELDS = (
    "numero long, charge timestamp_ntz, tables map<string,string>, parties map<string,map<int,string>>, schemas map<string,string>,"
    " lots array<string>, cellules int, paquets int"
)


@dataclass
class Generation:
    """Where the rows of a root are: one token per table or part of a table, their schemas, and the lots of the key index."""

    number: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    parts: dict[str, dict[int, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    lots: list[str] = field(default_factory=list)
    cells: int = 0
    buckets: int = 0

    def folders(self) -> set[tuple[str, str]]:
        """(table, token) of every folder with live rows; a lot is known by its token alone (table "")."""
        parts = {(name, token) for name, parts in self.parts.items() for token in parts.values()}
        return parts | set(self.tables.items()) | {("", token) for token in self.lots}


def generations(spark: SparkSession, root: str, last: int = 1) -> list[Generation]:
    """The last published generations, newest first; none before the first load."""
    try:
        rows = spark.read.schema(_FIELDS).parquet(f"{root}/{_MANIFEST}").orderBy(F.desc("numero")).limit(last + 1).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if len(rows) > 1 and rows[0].numero == rows[1].numero:
        raise RuntimeError(f"{root}: two loads published generation {rows[0].numero}")
    return [Generation(r.numero, r.tables, r.parties, r.schemas, r.lots, r.cellules, r.paquets) for r in rows[:last]]


def current(spark: SparkSession, root: str) -> Generation:
    return next(iter(generations(spark, root)), Generation())


def read_whole(spark: SparkSession, root: str, held: Generation, name: str) -> DataFrame | None:
    """A table that is replaced as a whole, or None if the generation does not have it."""
    token = held.tables.get(name)
    return spark.read.schema(_schema(held, name)).parquet(f"{root}/{name}/{TOKEN}={token}") if token else None


def read_parts(
    spark: SparkSession, root: str, held: Generation, name: str, part: str, only: Iterable[int] | None = None
) -> DataFrame | None:
    """A table in parts, with its part column; only the folders of the live (and wanted) parts are read."""
    live = held.parts.get(name)
    if live is None:
        return None
    schema = _schema(held, name).add(part, IntegerType())
    wanted = live if only is None else {p: live[p] for p in only if p in live}
    if not wanted:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(StructType([*schema.fields, StructField(TOKEN, StringType())])).parquet(f"{root}/{name}")
    return stored.filter(_live(wanted, part)).drop(TOKEN)


def _schema(held: Generation, name: str) -> StructType:
    return StructType.fromJson(json.loads(held.schemas[name]))


def _live(parts: dict[int, str], part: str) -> Column:
    """A filter on the partition columns alone."""
    by_token = defaultdict(list)
    for value, token in parts.items():
        by_token[token].append(value)
    tests = [(F.col(TOKEN) == token) & F.col(part).isin(sorted(values)) for token, values in sorted(by_token.items())]
    return reduce(lambda a, b: a | b, tests)


class Load:
    """The changes of one load; nothing is visible before publish()."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = current(spark, self.root)
        self.next = Generation(
            self.base.number + 1, dict(self.base.tables), {n: dict(p) for n, p in self.base.parts.items()},
            dict(self.base.schemas), list(self.base.lots), self.base.cells, self.base.buckets,
        )
        self.token = f"g{self.next.number}-{uuid.uuid4().hex[:12]}"

    def replace(self, name: str, df: DataFrame) -> str:
        """A whole table anew. df may read from the stored one."""
        path = f"{self.root}/{name}/{TOKEN}={self.token}"
        parquet_writer(df).parquet(path)
        self.next.tables[name], self.next.schemas[name] = self.token, df.schema.json()
        return path

    def rewrite(self, name: str, df: DataFrame, part: str, touched: Iterable[int], placed: bool = False) -> None:
        """The touched parts of a table anew: df holds all their rows, and none of others. Parts without rows end.

        The rebalance hint splits a part that is too large for one task; rows that are placed by part already stay where they are.
        """
        path = f"{self.root}/{name}/{TOKEN}={self.token}"
        live = self.next.parts.setdefault(name, {})
        for value in touched:
            live.pop(value, None)
        self.next.schemas[name] = df.drop(part).schema.json()
        parquet_writer(df if placed else df.hint("rebalance", F.col(part))).partitionBy(part).parquet(path)
        prefix = f"{part}="
        live.update((int(child.removeprefix(prefix)), self.token) for child in children(self.spark, path) if child.startswith(prefix))

    def publish(self, loaded_at: datetime) -> None:
        if current(self.spark, self.root).number != self.base.number:
            raise RuntimeError(f"{self.root}: another load published generation {self.next.number}; run this one again")
        n = self.next
        row = (n.number, loaded_at, n.tables, n.parts, n.schemas, n.lots, n.cells, n.buckets)
        self.spark.createDataFrame([row], _FIELDS).coalesce(1).write.mode("append").parquet(f"{self.root}/{_MANIFEST}")


def retire(spark: SparkSession, root: str, keep: int = 2, of_lots: tuple[str, ...] = ("cles", "filtres")) -> list[str]:
    """Remove the folders that none of the last generations names; returns them. Run it while no load is running.

    A reader that opened an older generation than those kept loses its files.
    """
    root = root.rstrip("/")
    named = {folder for held in generations(spark, root, keep) for folder in held.folders()}
    gone = []
    for table in children(spark, root):
        for child in children(spark, f"{root}/{table}"):
            owner = "" if table in of_lots else table
            if child.startswith(f"{TOKEN}=") and (owner, child.removeprefix(f"{TOKEN}=")) not in named:
                remove(spark, f"{root}/{table}/{child}")
                gone.append(f"{table}/{child}")
    return gone

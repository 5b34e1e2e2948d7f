"""Records of delivered files that may span lines, read by many tasks per file.

A reader that starts in the middle of a file does not know whether it stands
inside a quoted text. So a file is cut into short pieces (CSV at line ends, JSON
at closing braces) and read by byte blocks in three steps:

1. each block is scanned under both assumptions, outside and inside a quoted text,
   and gives the state at its end under each, and how much deeper it ends;
2. a prefix scan over the blocks of each file, one small row a block, gives the
   true state at every block's start;
3. each block is cut into records from its true state. What it begins but does not
   end, and what it continues from the block before, are joined by their places.

Any file system that Spark reads will do, and no task holds more than one record.
The states are one staged row a block (128 MB of input by default), broadcast by
an 8-byte digest of the file's path: 20 MB for 100 TB.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package


class State(NamedTuple):
    inside: bool  # of a quoted text
    depth: int  # of braces


class Step(NamedTuple):
    begins: int | None  # where in the piece a record begins
    after: State
    ends: bool  # the record that is open ends with this piece


class CsvRecords:
    """A record ends at a line end outside quotes; a quote is doubled inside them and literal in an unquoted cell."""

    piece_end, closing = "\n", ""
    _cell = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
    _opens = re.compile(rf'(?:{_cell},)*+"[^"]*+(?:""[^"]*+)*+\Z')
    _closes = re.compile(r'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,|\Z)')

    def step(self, piece: str, state: State, exact: bool = True) -> Step:
        inside = state.inside
        if '"' in piece:
            rest = 0
            if inside:
                found = self._closes.match(piece)
                rest, inside = (found.end(), False) if found else (0, True)
            # A line that closes its text in the last cell leaves nothing to open another.
            inside = inside or self._opens.match(piece, rest) is not None
        return Step(None if state.inside else 0, State(inside, 0), not inside)

    def open(self, state: State) -> bool:
        return state.inside


class JsonItems:
    """The objects of the root's only array: those between brace depths one and two. Pieces lack the closing brace.

    Another text at the root than the array's name stops the read.
    """

    piece_end, closing = "}", "}"
    _rest = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
    _token = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+("?)|\{', re.DOTALL)

    def __init__(self, name: str) -> None:
        self.name = f'"{name}"'

    def step(self, piece: str, state: State, exact: bool = True) -> Step:
        inside, depth, at = state.inside, state.depth, 0
        begins = None
        if inside:
            found = self._rest.match(piece)
            if not found:
                return Step(None, state, False)
            inside, at = False, found.end()
        for token in self._token.finditer(piece, at):
            if token.group() == "{":
                depth += 1
                if depth == 2 and begins is None:
                    begins = token.start()
            else:
                inside = not token.group(1)
                if exact and depth == 1 and token.group() != self.name:
                    raise ValueError(f"{token.group()[:80]} beside the array {self.name}")
        if inside:
            return Step(begins, State(True, depth), False)
        return Step(begins, State(False, depth - 1), depth == 2)

    def open(self, state: State) -> bool:
        return state.depth >= 2


Format = CsvRecords | JsonItems


def scan(form: Format, pieces: Iterator[str]) -> tuple[State, State]:
    """The state after a block that begins outside, and after one that begins inside a quoted text."""
    out, inner = State(False, 0), State(True, 0)
    for piece in pieces:
        same = out.inside == inner.inside
        out, gained = form.step(piece, out, False).after, out.depth
        # Once both agree on the quotes, they differ by a constant depth only.
        inner = State(out.inside, inner.depth + out.depth - gained) if same else form.step(piece, inner, False).after
    return out, inner


def cut(form: Format, pieces: Iterator[str], state: State) -> Iterator[tuple[int, bool, str]]:
    """(piece number, whole, text) of each record of a block that begins in the state.

    The text that continues a record of the block before has number -1.
    """
    held: list[str] | None = [] if form.open(state) else None
    row = -1
    for k, piece in enumerate(pieces):
        begins, after, ends = form.step(piece, state)
        if held is not None:
            held.append(piece)
        elif begins is not None:
            held, row = [piece[begins:]], k
        if held is not None and ends:
            yield row, row >= 0, form.piece_end.join(held)
            held = None
        state = after
    if held:
        yield row, False, form.piece_end.join(held)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """The pieces of each block, which lie together in file order; all columns but the last are the block's."""
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    for block, own in groupby(rows, key=lambda row: row[:-1]):
        yield block, (row[-1] for row in own)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema)


def _scan_task(form: Format):
    schema = pa.schema(
        [("_fichier", pa.string()), ("_bloc", pa.int64()), ("out_in", pa.bool_()), ("out_depth", pa.int64()),
         ("in_in", pa.bool_()), ("in_depth", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, pieces in _runs(batches):
            out, inner = scan(form, pieces)
            yield _batch([(*block, *out, *inner)], schema)

    return run


def _cut_task(form: Format, size: int = 4096):
    schema = pa.schema(
        [("_fichier", pa.string()), ("_bloc", pa.int64()), ("_ligne", pa.int64()), ("whole", pa.bool_()), ("_texte", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for (file, block, inside, depth), pieces in _runs(batches):
            for found in cut(form, pieces, State(inside, depth)):
                rows.append((file, block, *found))
                if len(rows) == size:
                    yield _batch(rows, schema)
                    rows = []
        if rows:
            yield _batch(rows, schema)

    return run


def block_starts(pieces: DataFrame, form: Format) -> DataFrame:
    """(_fichier, _bloc, inside, depth, end_inside, end_depth): the true states of every block, by a prefix scan."""
    ends = pieces.mapInArrow(
        _scan_task(form),
        "_fichier string, _bloc long, out_in boolean, out_depth long, in_in boolean, in_depth long",
    )
    before = Window.partitionBy("_fichier").orderBy("_bloc").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("_fichier").orderBy("_bloc").rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("out_in") == F.col("in_in")  # the block ends alike, however it begins
    swaps = F.col("out_in") & ~F.col("in_in")
    known = ends.withColumn("swaps", F.sum(swaps.cast("int")).over(through))
    state = F.coalesce(F.last(F.when(fixed, F.col("out_in")), ignorenulls=True).over(before), F.lit(False))
    since = F.coalesce(F.max("swaps").over(before), F.lit(0)) - F.coalesce(
        F.last(F.when(fixed, F.col("swaps")), ignorenulls=True).over(before), F.lit(0)
    )
    inside = known.withColumn("inside", state != (since % 2 == 1))
    deeper = inside.withColumn("deeper", F.when(F.col("inside"), F.col("in_depth")).otherwise(F.col("out_depth")))
    return deeper.select(
        "_fichier", "_bloc", "inside", F.coalesce(F.sum("deeper").over(before), F.lit(0)).alias("depth"),
        F.when(F.col("inside"), F.col("in_in")).otherwise(F.col("out_in")).alias("end_inside"),
        F.sum("deeper").over(through).alias("end_depth"),
    )


def read_records(spark: SparkSession, path: str, form: Format) -> DataFrame:
    """(_fichier, _bloc, _ligne, _texte): every record, at the place of its first piece.

    The files are read for the states and for the records; blocks that begin or
    end within a record are read once more for the parts of that record.
    """
    pieces = (
        spark.read.option("lineSep", form.piece_end)
        .text(path)
        .select(F.col("_metadata.file_path").alias("_fichier"), F.col("_metadata.file_block_start").alias("_bloc"), "value")
    )
    starts = stage(block_starts(pieces, form), "blocks")
    keys = (F.xxhash64("_fichier").alias("_f"), F.col("_bloc").alias("_b"))
    known = starts.select(*keys, "inside", "depth", "end_inside", "end_depth")

    crossing = "inside or end_inside" if isinstance(form, CsvRecords) else "depth >= 2 or end_depth >= 2"

    def cut_blocks(blocks: str) -> DataFrame:
        here = (F.xxhash64("_fichier") == F.col("_f")) & (F.col("_bloc") == F.col("_b"))
        moved = F.raise_error(F.lit("the blocks of the files have changed during the read: read again")).cast("boolean")
        # A left join, since a block without a state must stop the read instead of losing its records.
        placed = pieces.join(F.broadcast(known), here, "left").filter(F.when(F.col("inside").isNull(), moved).otherwise(F.expr(blocks)))
        return placed.select("_fichier", "_bloc", "inside", "depth", "value").mapInArrow(
            _cut_task(form), "_fichier string, _bloc long, _ligne long, whole boolean, _texte string"
        )

    whole = cut_blocks("true").filter("whole").drop("whole")
    parts = cut_blocks(crossing).filter("not whole")
    in_order = Window.partitionBy("_fichier").orderBy("_bloc", "_ligne")
    joined = (
        parts.withColumn("record", F.sum((F.col("_ligne") >= 0).cast("int")).over(in_order))
        .groupBy("_fichier", "record")
        .agg(F.array_sort(F.collect_list(F.struct("_bloc", "_ligne", "_texte"))).alias("parts"))
        .select(
            "_fichier", F.col("parts")[0]["_bloc"].alias("_bloc"), F.col("parts")[0]["_ligne"].alias("_ligne"),
            F.concat_ws(form.piece_end, F.col("parts._texte")).alias("_texte"),
        )
    )
    return whole.unionByName(joined).withColumn("_texte", F.concat("_texte", F.lit(form.closing)))

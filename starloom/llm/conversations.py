"""Repair of conversation structure by the cheapest edits: a run-length min-plus program.

A conversation must read system? (user assistant)+, or be empty. Every turn is kept
(free), given the other role (2), or deleted (3; blank and repeated turns must be);
empty turns are inserted (2). A truncated turn that is not deleted costs 1 more.

Each turn is a symbol of role initial and fault. Equal neighbours are collapsed into
runs. A symbol is a 4 x 4 min-plus matrix over the states of the structure; a run of
n of them is passed by the binary powers of its matrix, which each worker computes
once. From the costs behind each run the edits are unrolled forwards, the least letter
first, by blocks of a power of two whose edits are remembered, too.

In Spark, turns that repeat are found by one grouping on digests. Then a conversation's
turns come to one task, once as symbols and after them with their texts, both in order,
and stream through it: the symbols give the edits, the edits turn texts into output. A
task holds a batch of texts, and of one conversation the runs of symbols and the edits,
never its texts. A conversation's digest is one sequential hash, so that its texts have to pass
one task in order; everything before that is spread over all rows.

Order: turn (nulls first), then role and digest of the text. Edge cases: null roles and
texts count as one space. Conversations with a null id are one conversation. Repeated rows
are repeated turns. A conversation without turns keeps its row in the audit: zeros, no edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starloom.llm.frames import prepare

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
WHITE = " \t\n\x0b\f\r"
# States: nothing yet, after system, after user, after assistant. The middle two cannot end a conversation.
STATES = range(4)
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
# The state and role that an inserted turn, or one with a new role, leads to.
_FILLED = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_AT_END = (0, 4, 2, 0)
_FAR = 1 << 60

Symbol = tuple[str, str]  # role initial, fault that decides the cost: "", TRUNCATED, or DELETE where deletion is due
Vector = tuple[int, ...]


def symbol(role: str, fault: str) -> Symbol:
    if fault in (BLANK, DUPLICATE):
        return "", DELETE
    initial = role[:1]
    return initial if initial in _NEXT else "", fault


@cache
def _edits(of: Symbol, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, next state) of the edits of one turn, in the order of their letters."""
    initial, fault = of
    found = [(DELETE, COST[DELETE], state)]
    if fault != DELETE:
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        kept = _NEXT[initial][state] if initial else None
        if kept is not None:
            found.append((KEEP, COST[KEEP] + more, kept))
        found.append((REROLE, COST[REROLE] + more, _FILLED[state]))
    return tuple(found)


@cache
def _power(of: Symbol, exponent: int) -> tuple[Vector, ...]:
    """The matrix of 2**exponent turns: the least cost from each state before them to each state after."""
    if exponent:
        half = _power(of, exponent - 1)
        return tuple(tuple(min(half[a][m] + half[m][b] for m in STATES) for b in STATES) for a in STATES)
    rows = []
    for first in STATES:
        row, state = [_FAR] * 4, first
        # More than three insertions in a row visit a state again.
        for inserted in range(4):
            for _, cost, to in _edits(of, state):
                row[to] = min(row[to], inserted * COST[INSERT] + cost)
            state = _FILLED[state]
        rows.append(tuple(row))
    return tuple(rows)


def _before(of: Symbol, exponent: int, after: Vector) -> Vector:
    """The least cost to the end from each state before 2**exponent turns."""
    return tuple(min(cost + then for cost, then in zip(row, after)) for row in _power(of, exponent))


# Blocks of up to 2**8 turns are remembered; the number of their symbols, states and relative costs is small.
_REMEMBERED = 8


def _unroll(of: Symbol, exponent: int, state: int, after: Vector) -> tuple[str, int]:
    """The edits of 2**exponent turns from a state, and the state they lead to; after is relative to its least cost."""
    return (_remembered if exponent <= _REMEMBERED else _unrolled)(of, exponent, state, after)


@cache
def _remembered(of: Symbol, exponent: int, state: int, after: Vector) -> tuple[str, int]:
    return _unrolled(of, exponent, state, after)


def _unrolled(of: Symbol, exponent: int, state: int, after: Vector) -> tuple[str, int]:
    if exponent:
        middle = _before(of, exponent - 1, after)
        first, state = _unroll(of, exponent - 1, state, _relative(middle))
        second, state = _unroll(of, exponent - 1, state, after)
        return first + second, state
    letters, costs = "", _before(of, 0, after)
    while True:
        for letter, cost, to in _edits(of, state):
            # Insertion comes after deletion and before the other two.
            if letter != DELETE and costs[state] == COST[INSERT] + costs[_FILLED[state]]:
                break
            if costs[state] == cost + after[to]:
                return letters + letter, to
        letters, state = letters + INSERT, _FILLED[state]


def _relative(costs: Vector) -> Vector:
    least = min(costs)
    return tuple(cost - least for cost in costs)


def cheapest_edits(runs: list[tuple[Symbol, int]]) -> tuple[int, str]:
    """The least cost of repair and the least of the edit sequences that have it."""
    after, blocks = _AT_END, []
    for of, count in reversed(runs):
        for exponent in range(count.bit_length()):
            if count >> exponent & 1:
                blocks.append((of, exponent, _relative(after)))
                after = _before(of, exponent, after)
    letters, state = [], 0
    for of, exponent, costs in reversed(blocks):
        edits, state = _unroll(of, exponent, state, costs)
        letters.append(edits)
    letters.append(INSERT * (_AT_END[state] // COST[INSERT]))
    return after[0], "".join(letters)


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns as a faulty collection would hold them, by a checksum of conversation and turn: of 20 turns one each is
    dropped, emptied, without ends of sentences, there twice, or the user's. Nulls count as one space.

    Dropped turns stay as rows that are marked so (_lost), since their conversation is still to be returned.
    """
    drawn = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.coalesce("role", F.lit(" ")).alias("_role"), text.alias("_text"), drawn.alias("_drawn"))
        .withColumn("_copy", F.explode(F.when(F.col("_drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "_conv",
            "_turn",
            F.when(F.col("_drawn") == 4, "user").otherwise(F.col("_role")).alias("_role"),
            F.when(F.col("_drawn") == 1, "").when(F.col("_drawn") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text")).alias("_text"),
            (F.col("_drawn") == 0).alias("_lost"),
        )
    )


def as_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Undamaged turns in the columns that the repair takes; nulls count as one space."""
    role, text = (F.coalesce(name, F.lit(" ")).alias(f"_{name}") for name in ("role", "text"))
    return turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), role, text, F.lit(False).alias("_lost"))


def _marked(turns: DataFrame) -> DataFrame:
    """Per turn what the edits follow from: _fault, and whether its text is one that an earlier turn may have."""
    trimmed = F.rtrim(F.col("_text"), F.lit(WHITE))
    ends_well = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    fault = F.when(trimmed == "", BLANK).when(~ends_well, TRUNCATED).otherwise("")
    digest = F.when(~F.col("_lost"), F.unhex(F.sha2("_text", 256)))
    rows = turns.select("_conv", "_turn", "_role", digest.alias("_digest"), "_lost", F.when(~F.col("_lost"), fault).alias("_fault"))
    place = F.struct(F.col("_turn").isNotNull().alias("known"), F.col("_turn").alias("turn"))
    said = rows.filter(f"not _lost and _fault <> '{BLANK}'").groupBy("_conv", "_role", "_digest")
    again = said.agg(F.count("*").alias("_n"), F.min(place).alias("_first")).filter("_n > 1")
    again = again.select(F.col("_conv").alias("_c"), F.col("_role").alias("_r"), F.col("_digest").alias("_d"), "_first")
    same = F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    joined = rows.join(again, same & (F.col("_fault") != BLANK), "left")
    later = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(place)
    return joined.select("_conv", "_turn", "_role", "_digest", "_lost", F.when(later, DUPLICATE).otherwise(F.col("_fault")).alias("_fault"))


def _streamed(turns: DataFrame) -> DataFrame:
    """Each conversation's turns in one partition and in order: first their marks, then their texts."""
    marks = _marked(turns).select(F.lit(0).alias("_pass"), "*", F.lit(None).cast("string").alias("_text"))
    digest = F.unhex(F.sha2("_text", 256)).alias("_digest")
    texts = turns.filter("not _lost").select(
        F.lit(1).alias("_pass"), "_conv", "_turn", "_role", digest, "_lost", F.lit(None).cast("string").alias("_fault"), "_text"
    )
    both = marks.unionByName(texts).repartition("_conv")
    # Of dropped turns only the conversation counts: they come first.
    return both.sortWithinPartitions("_conv", "_pass", F.col("_lost").desc(), F.asc_nulls_first("_turn"), "_role", "_digest")


class _Marks:
    """What the marks of one conversation add up to."""

    def __init__(self):
        self.runs: list[list] = []
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal = self.turns = self.distinct = 0
        self.least = self.greatest = self.last = self.initial = None

    def add(self, turn, role, digest, fault) -> None:
        # Equal rows are neighbours; the first of a text's earliest ones is no repetition.
        if fault != BLANK and self.last == (turn, role, digest):
            fault = DUPLICATE
        if self.turns:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        if turn is not None and turn != self.greatest:
            self.distinct += 1
            self.least = turn if self.least is None else self.least
            self.greatest = turn
        self.last, self.initial = (turn, role, digest), role[:1]
        self.turns += 1
        if fault:
            self.faults[fault] += 1
        of = symbol(role, fault)
        if self.runs and self.runs[-1][0] == of:
            self.runs[-1][1] += 1
        else:
            self.runs.append([of, 1])

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.greatest - self.least + 1 - self.distinct


def _edited(letters: str, texts: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """(letter, new role, old role, text) for every edit, in order; deleted turns have no new role, inserted ones no old."""
    state = 0
    for letter in letters:
        old, text = (None, "") if letter == INSERT else next(texts)
        if letter == DELETE:
            yield letter, None, old, text
            continue
        state = _NEXT[old[:1]][state] if letter == KEEP else _FILLED[state]
        yield letter, old if letter == KEEP else _ROLE[state], old, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Marks, int, str, Iterator]]:
    """(conversation, marks, cost, edits, edited turns) for each conversation of a sorted stream."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in ("_conv", "_pass", "_turn", "_role", "_digest", "_lost", "_fault", "_text")))

    for conv, group in groupby(rows(), key=lambda row: row[0]):
        marks, first = _Marks(), None
        for row in group:
            if row[1]:
                first = row
                break
            if not row[5]:
                marks.add(row[2], row[3], row[4], row[6])
        cost, letters = cheapest_edits([(of, n) for of, n in marks.runs])

        def texts(first=first, group=group):
            if first:
                yield first[3], first[7]
            for row in group:
                yield row[3], row[7]

        yield conv, marks, cost, letters, _edited(letters, texts())


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000, weight: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or held_bytes >= weight:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


AUDIT = ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation of as_turns() or damage(): faults, the edits that repair it, and the repaired text's digest."""
    prepare(turns.sparkSession)
    kind = turns.schema["_conv"].dataType
    counts = [(name, pa.int64()) for name in AUDIT]
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *counts, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def work(batches):
        def rows():
            for conv, marks, cost, letters, edited in _conversations(batches):
                digest, between = hashlib.sha256(), b""
                for _, role, _, text in edited:
                    if role is not None:
                        digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                        between = b"\n"
                yield (conv, marks.gaps, *marks.faults.values(), marks.illegal, cost, letters, digest.hexdigest())

        yield from _in_batches(rows(), schema)

    longs = ", ".join(f"`{name}` long" for name in AUDIT)
    return _streamed(turns).mapInArrow(work, f"conv_id {kind.simpleString()}, {longs}, audit string, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """The repaired turns of as_turns() or damage(): conv_id, position, role, text, and the edit (K, R or I) each came from."""
    prepare(turns.sparkSession)
    kind = turns.schema["_conv"].dataType
    texts = [(name, pa.string()) for name in ("role", "text", "edit")]
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("position", pa.int64()), *texts])

    def work(batches):
        def rows():
            for conv, _, _, _, edited in _conversations(batches):
                stay = ((letter, role, text) for letter, role, _, text in edited if role is not None)
                for position, (letter, role, text) in enumerate(stay):
                    yield conv, position, role, text, letter

        yield from _in_batches(rows(), schema)

    return _streamed(turns).mapInArrow(work, f"conv_id {kind.simpleString()}, position long, role string, text string, edit string")


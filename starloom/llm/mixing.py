"""Interleaving sources to target weights by Pfair scheduling.

Time is cut into slots of one block. A source of weight w must have started
block k not before slot floor(k / w) and finished it by slot ceil((k + 1) / w):
its release time and deadline. In each slot the released block with the earliest
deadline goes next. Every source then stays less than one block away from its
fluid share, at every moment.

Release times and deadlines are computed in whole numbers from the exact weights,
never from rounded shares, so the deviation does not grow with the input. Blocks
are scheduled from the sources' counts alone, by tasks that take a stretch of the
slots each (pfair.py); slots in which nothing is released are passed over. A source's documents are put into a fixed random order
(a hash of the id), numbered in parallel, and cut into blocks, which are joined
with their slots.

No document is dropped or repeated. The target shares hold up to the slot where
the first source ends; from there the others go on at their own pace, and slots
stay empty.

Edge cases: null is a source of its own; a source without a weight gets the
smallest positive weight given; weights of sources that do not occur take part
in the shares, their slots stay empty; repeated rows are further documents, next to
each other in their source's order, and so are rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.frames import BROADCAST_ROWS, prepare
from starloom.llm.pfair import Plan
from starloom.session import stage


NO_SOURCE = "\0null"


@dataclass(frozen=True)
class Mixing:
    block_rows: int = 16
    # Slots of so many blocks of a source are one row of the schedule; one task schedules about so many blocks.
    run_blocks: int = 1_024
    portion: int = 1_000_000
    # Documents of a source are numbered in this many parts, or as many as there are shuffle partitions.
    parts: int = 256


def shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Whole slots per period, at least one each, nearest to the weights; they add up to the period."""
    total = sum(weights.values())
    exact = {s: max(w / total * period, 1.0) for s, w in weights.items()}
    scale = period / sum(exact.values())
    whole = {s: max(1, int(x * scale)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (whole[s] - exact[s] * scale, s))
    missing = period - sum(whole.values())
    for k in range(abs(missing)):
        if missing > 0:
            whole[by_rest[k % len(by_rest)]] += 1
        else:
            whole[max(whole, key=lambda s: (whole[s], s))] -= 1
    return whole


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def plan_of(whole: Mapping[str, int], blocks: Mapping[str, int]) -> tuple[list[str], Plan]:
    """The sources in their order, and their blocks' release times and deadlines."""
    names = sorted(whole)
    return names, Plan([whole[s] for s in names], [blocks.get(s, 0) for s in names], sum(whole.values()))


def slots_of(whole: Mapping[str, int], blocks: Mapping[str, int]) -> Iterator[tuple[int, str, int]]:
    """(slot, source, block) by slot, for so many blocks of each source: earliest deadline first among released blocks.

    whole are exact weights. Leaving out the blocks that a source does not hold
    only frees slots, so all others keep within their release times and deadlines.
    """
    names, plan = plan_of(whole, blocks)
    for slot, s, k in plan.slots(0, None, ()):
        yield slot, names[s], k


def schedule(whole: Mapping[str, int]) -> dict[str, list[int]]:
    """For each source the slots of its blocks up to the slot where all have had exactly their weight."""
    slots: dict[str, list[int]] = {s: [] for s in whole}
    for slot, source, _ in slots_of(whole, whole):
        slots[source].append(slot)
    return slots


def schedule_table(spark: SparkSession, whole: Mapping[str, int], blocks: Mapping[str, int], how: Mixing) -> DataFrame:
    """(_source, _run, _slots): the slots of each source's blocks, run_blocks a row, the same as in one sequential schedule.

    One task schedules a stretch of about portion blocks. The driver passes over the stretches once, for what
    waits at each cut: one number for each source and stretch, at most a sixteenth as many as there are blocks.
    """
    names, plan = plan_of(whole, blocks)
    cuts = plan.cuts(max(how.portion, 16 * len(names)))
    stretches = list(zip(cuts, cuts[1:], strict=False))
    prepare(spark)

    def crowding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_pydict({"j": [j], "most": pa.array([plan.crowding(*stretches[j])], pa.list_(pa.int64()))})

    waiting: list[list[int]] = [[] for _ in stretches]
    if len(stretches) > 1:
        inner = spark.range(0, len(stretches) - 1, 1, len(stretches) - 1)
        found = inner.mapInArrow(crowding, "j long, most array<long>").toArrow().sort_by("j").column("most")
        for j, most in enumerate(found):
            waiting[j + 1] = plan.waiting_at(*stretches[j], waiting[j], most.as_py())

    def scheduled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j, left in zip(batch.column("j").to_pylist(), batch.column("left").to_pylist(), strict=True):
                runs: dict[tuple[int, int], tuple[int, list[int]]] = {}
                for slot, s, k in plan.slots(*stretches[j], left):
                    runs.setdefault((s, k // how.run_blocks), (k, []))[1].append(slot)
                if runs:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "_source": [names[s] for s, _ in runs],
                            "_run": [run for _, run in runs],
                            "_first": [first for first, _ in runs.values()],
                            "_part": pa.array([slots for _, slots in runs.values()], pa.list_(pa.int64())),
                        }
                    )

    # As an Arrow table, which needs no Python worker beside those of the operators.
    given = pa.table({"j": pa.array(range(len(waiting)), pa.int64()), "left": pa.array(waiting, pa.list_(pa.int64()))})
    rows = spark.createDataFrame(given).repartitionByRange(max(1, len(stretches)), "j")
    parts = rows.mapInArrow(scheduled, "_source string, _run long, _first long, _part array<long>")
    # A run that a cut divides comes in parts, at most run_blocks slots together.
    parts = parts.groupBy("_source", "_run").agg(F.sort_array(F.collect_list(F.struct("_first", "_part"))).alias("_parts"))
    return stage(parts.select("_source", "_run", F.flatten(F.col("_parts._part")).alias("_slots")), "slots")


def numbered(docs: DataFrame, source: str, key: str, parts: int) -> DataFrame:
    """(_source, _id, _rank, _n): the first of _n neighbouring places for the rows of an id, 0, 1, ... inside each source.

    Sources are in the order of a hash of the id, and cut into parts by it, so that no task numbers a whole source.
    Rows without an id, or with the same id, are one row with their number, however many they are.
    """
    base = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("_source"), F.col(key).alias("_id"))
    base = base.agg(F.count("*").alias("_n")).withColumn("_draw", F.xxhash64("_id", F.lit(5)))
    base = base.withColumn("_part", F.floor((F.col("_draw") / 2.0**64 + 0.5) * parts).cast("int"))
    sizes = base.groupBy("_source", "_part").agg(F.sum("_n").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("_source").orderBy("_part")) - F.col("_rows")
    offsets = sizes.select("_source", "_part", before.alias("_before"))
    order = Window.partitionBy("_source", "_part").orderBy("_draw", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = base.withColumn("_inside", F.sum("_n").over(order) - F.col("_n"))
    return ranked.join(offsets, ["_source", "_part"]).select("_source", "_id", (F.col("_before") + F.col("_inside")).alias("_rank"), "_n")


def source_counts(docs: DataFrame, source: str) -> dict[str, int]:
    """Documents by source; the driver holds one entry for each."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE))
    found = docs.groupBy(name.alias("_source")).agg(F.count("*").alias("_n")).toArrow()
    return dict(zip(found.column("_source").to_pylist(), found.column("_n").to_pylist(), strict=True))


def natural_weights(docs: DataFrame, source: str, power: float = 0.5) -> dict[str, float]:
    """Weights count ** power, over all documents: below 1 small sources get more than their share."""
    return {s: float(n) ** power for s, n in source_counts(docs, source).items()}


def mix(docs: DataFrame, weights: Mapping[str, float], source: str = "source", key: str = "doc_id", how: Mixing = Mixing()) -> DataFrame:
    """(key, source, block, slot, position, share) per row of docs.

    block counts the source's blocks, slot is the block's place in the mix,
    position orders all documents, share is the source's exact weight.
    """
    spark = docs.sparkSession
    parts = max(how.parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = numbered(docs, source, key, parts)
    given = {NO_SOURCE if s is None else s: float(w) for s, w in weights.items() if w > 0}
    counts = source_counts(docs, source)
    least = min(given.values(), default=1.0)
    given.update({s: least for s in counts if s not in given})
    if not given:
        return ranked.select(
            F.col("_id").alias(key), F.col("_source").alias(source), F.lit(0).cast("long").alias("block"),
            F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("position"), F.lit(0.0).alias("share"),
        )
    run_rows = how.run_blocks * how.block_rows
    whole, blocks = whole_weights(given), {s: -(-n // how.block_rows) for s, n in counts.items()}
    total = sum(whole.values())
    slots = schedule_table(spark, whole, blocks, how)
    shares = pa.array([whole[s] / total for s in blocks], pa.float64())
    weight = spark.createDataFrame(pa.table({"_source": pa.array(list(blocks), pa.string()), "share": shares}))
    pattern = slots.join(weight, "_source")
    # Rows of a run, run_blocks * block_rows at most, share a key, so that no source is a hot one. The rows of an id
    # are cut into runs before the join and told apart after it.
    last = F.col("_rank") + F.col("_n") - 1
    placed = ranked.withColumn("_last", last).withColumn("_run", F.explode(F.sequence(F.floor(F.col("_rank") / run_rows), F.floor(last / run_rows))))
    placed = placed.join(pattern, ["_source", "_run"])
    own = F.sequence(F.greatest("_rank", F.col("_run") * run_rows), F.least("_last", (F.col("_run") + 1) * run_rows - 1))
    placed = placed.withColumn("_rank", F.explode(own)).withColumn("block", F.floor(F.col("_rank") / how.block_rows))
    placed = placed.withColumn("slot", F.element_at("_slots", (F.col("block") % how.run_blocks + 1).cast("int")))
    return placed.select(
        F.col("_id").alias(key),
        F.when(F.col("_source") != NO_SOURCE, F.col("_source")).alias(source),
        "block",
        "slot",
        (F.col("slot") * how.block_rows + F.col("_rank") % how.block_rows).alias("position"),
        "share",
    )


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float], source: str = "source", key: str = "doc_id", how: Mixing = Mixing()) -> DataFrame:
    """All rows of docs with their mix_position, sorted by it across and inside the partitions, and so in files written from it.

    A reader may take the files in any order, so the column is what later stages go by. Of a repeated id all rows
    stand at its first position; rows without an id come last and have none.
    """
    places = mix(docs, weights, source, key, how).groupBy(F.col(key).alias("_key")).agg(F.min("position").alias("_position"))
    places = stage(places.filter("_key is not null"), "positions")
    if places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    placed = docs.join(places, docs[key] == places["_key"], "left")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("_position").asc_nulls_last()
    return placed.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("mix_position", F.col("_position")).drop("_key", "_position")

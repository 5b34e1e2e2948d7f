"""Which month holds an order line: an index of the stored keys, so that a load need not read them all.

Every load adds a lot of the keys that are new or have moved, in hash buckets (a folder each), with their month.
Beside each bucket lie Bloom filters, one for each cell of keys: 4 of 32,768 bits are set per key, all in the bitmap of the
key's cell, about 16 bits a key. A batch meets the filters of its buckets first; only buckets of lots that may hold
one of its keys are read, and there the keys are compared. A false positive costs a
read, never a row. The newest lot that has a key is right about its month. When there are many lots they are merged into one.
Further columns of the keys, such as the load time of a line, are kept beside the month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starloom.session import children, parquet_writer, side_by_side
from starloom.sinks.generations import TOKEN, Generation, Load

KEYS, FILTERS = "cles", "filtres"
CELL_KEYS = 2000
# A bucket of the first load has about so many keys; there are at most MOST_BUCKETS.
BUCKET_KEYS, MOST_BUCKETS = 500_000, 4096
MOST_LOTS = 8
_BITS, _HASHES = 15, 4
# One key in so many is tried first.
FEW = 64


def _placed(keys: DataFrame, key: str, held: Generation) -> DataFrame:
    cell = F.pmod(F.xxhash64(key), F.lit(held.cells)).cast("int")
    return keys.withColumn("cellule", cell).withColumn("paquet", F.pmod(F.col("cellule"), F.lit(held.buckets)).cast("int"))


def _positions(key: str) -> list[Column]:
    bits = F.xxhash64(F.lit("filtre"), F.col(key))
    return [F.shiftright(bits, _BITS * k).bitwiseAND((1 << _BITS) - 1) for k in range(_HASHES)]


def _is_set(bitmap: str, position: Column) -> Column:
    byte = F.substring(F.col(bitmap), (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), position.bitwiseAND(7).cast("int")) == 1


def add_lot(load: Load, keys: DataFrame, key: str, month: str) -> None:
    """Note the months of keys, each given once, and their further columns in a lot of this load."""
    if not load.next.cells:
        n = keys.count()
        load.next.buckets = max(8, min(MOST_BUCKETS, -(-n // BUCKET_KEYS)))
        load.next.cells = load.next.buckets * max(1, -(-n // (CELL_KEYS * load.next.buckets)))
    rows = _placed(keys, key, load.next)
    target = f"{TOKEN}={load.token}"
    stored = f"{load.root}/{KEYS}/{target}"
    # Shuffled before it is aggregated: a bitmap a cell and task would be far larger than the keys. By bucket, as the keys: dealt
    # by cell, every task would write a file into nearly every bucket, and their number would grow with the square of the keys.
    spread = rows.select(key, "cellule", "paquet").repartition("paquet").select("cellule", "paquet", F.explode(F.array(*_positions(key))).alias("bit"))
    cells = spread.groupBy("cellule", "paquet").agg(F.bitmap_construct_agg("bit").alias("bits"))
    side_by_side(
        load.spark,
        {
            "keys": lambda: parquet_writer(rows.drop("cellule").repartition("paquet")).partitionBy("paquet").parquet(stored),
            "filters": lambda: parquet_writer(cells).partitionBy("paquet").parquet(f"{load.root}/{FILTERS}/{target}"),
        },
    )
    if any(child.startswith("paquet=") for child in children(load.spark, stored)):
        load.next.lots.append(load.token)


def _stored(spark: SparkSession, root: str, name: str, schema: str, lots: list[str]) -> DataFrame:
    read = spark.read.schema(f"{schema}, {TOKEN} string, paquet int").parquet(f"{root}/{name}")
    return read.filter(F.col(TOKEN).isin(lots))


def candidates(spark: SparkSession, root: str, held: Generation, keys: DataFrame, key: str) -> DataFrame:
    """(key, generation, paquet): the lots and buckets that may hold each of the keys."""
    placed = _placed(keys.select(key), key, held)
    buckets = [r[0] for r in placed.select("paquet").distinct().collect()]  # at most MOST_BUCKETS numbers
    filters = _stored(spark, root, FILTERS, "cellule int, bits binary", held.lots).filter(F.col("paquet").isin(buckets))
    met = placed.join(filters, ["cellule", "paquet"])
    return met.filter(reduce(lambda a, b: a & b, [_is_set("bits", p) for p in _positions(key)])).select(key, TOKEN, "paquet")


def touched_buckets(spark: SparkSession, root: str, held: Generation, keys: DataFrame, key: str) -> list[Row]:
    """(generation, paquet) of the buckets that may hold one of the keys: at most MOST_LOTS times MOST_BUCKETS.

    A bucket needs one key that passes its filters, so a few keys are tried first. If they touch every bucket there is, as those of a large
    batch do, no more are tried; otherwise all keys are.
    """
    few = keys.filter(F.pmod(F.xxhash64(F.lit("essai"), F.col(key)), F.lit(FEW)) == 0)
    stored = {(lot, bucket) for lot in held.lots for bucket in _buckets(spark, root, lot)}
    for tried in (few, keys):
        touched = candidates(spark, root, held, tried, key).select(TOKEN, "paquet").distinct().collect()
        if {(r[0], r[1]) for r in touched} == stored:
            break
    return touched


def _buckets(spark: SparkSession, root: str, lot: str) -> list[int]:
    return [int(c.removeprefix("paquet=")) for c in children(spark, f"{root}/{KEYS}/{TOKEN}={lot}") if c.startswith("paquet=")]


def known_months(spark: SparkSession, root: str, held: Generation, keys: DataFrame, key: str, month: str) -> DataFrame:
    """(key, month) of those keys that are stored; of the index only buckets that may hold one are read."""
    return located(spark, root, held, keys.select(key), key, f"{month} int")


def located(spark: SparkSession, root: str, held: Generation, keys: DataFrame, key: str, kept: str) -> DataFrame:
    """Those of the keys that are stored, with the kept columns ("name type, ...") of the index; none that keys has."""
    touched = touched_buckets(spark, root, held, keys.select(key), key)
    found = _stored(spark, root, KEYS, f"{key} string, {kept}", held.lots).filter(in_buckets(touched))
    return _newest(found.join(keys, key), keys.columns, kept, held.lots)


def _newest(found: DataFrame, by: list[str], kept: str, lots: list[str]) -> DataFrame:
    """The kept columns of the newest lot that has a key."""
    rank = F.array_position(F.array(*map(F.lit, lots)), F.col(TOKEN))
    names = [field.split()[0] for field in kept.split(", ")]
    return found.groupBy(*by).agg(*[F.max_by(name, rank).alias(name) for name in names])


def in_buckets(touched) -> Column:
    """A filter on the partition columns alone."""
    by_lot: dict[str, list[int]] = {}
    for row in touched:
        by_lot.setdefault(row[0], []).append(row[1])
    tests = [(F.col(TOKEN) == lot) & F.col("paquet").isin(sorted(buckets)) for lot, buckets in sorted(by_lot.items())]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def merge_lots(load: Load, key: str, month: str, others: str = "") -> None:
    """All lots of a load as one, if there are many; others names the further columns (", name type")."""
    if len(load.next.lots) <= MOST_LOTS:
        return
    lots = load.next.lots
    kept = f"{month} int{others}"
    latest = _newest(_stored(load.spark, load.root, KEYS, f"{key} string, {kept}", lots), [key], kept, lots)
    # A lot of its own folder: this load's token may name one already.
    load.next.lots, load.next.cells, load.token = [], 0, f"{load.token}-fusion"
    add_lot(load, latest, key, month)

"""Idempotent upsert of the sales fact into month partitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import quality
from starloom.session import ROWS_PER_TASK, side_by_side, stage
from starloom.sinks.generations import Generation, Load, current, read_parts
from starloom.sinks.key_index import add_lot, located, merge_lots

FACT = "fait_ventes"
KEY = "id_commande"
MONTH = "annee_mois"
LOADED = "date_chargement"
# The month of a batch key where the index names another, and the one it had before.
AFTER, BEFORE = "_mois_lot", "_mois_avant"
# Columns a batch may leave out, with the value of a new line; known lines keep theirs.
OPTIONAL = {"cout_livraison": None, "delai_livraison_jours": None, "remise_pct": 0, "statut_commande": None}
STORED = f"{schemas.TABLES[FACT]}, {LOADED} timestamp_ntz"


def read_facts(spark: SparkSession, root: str, held: Generation, months: list[int] | None = None) -> DataFrame | None:
    """The sales of a generation with their partition and load-time columns, or None before the first load."""
    return read_parts(spark, root, held, FACT, MONTH, months)


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The sales last published below path."""
    return read_facts(spark, path.rstrip("/"), current(spark, path.rstrip("/")))


def upsert_facts(batch: DataFrame, path: str, loaded_at: datetime, staged: bool = False) -> None:
    """Merge a batch into the sales below path and publish them."""
    load = Load(batch.sparkSession, path)
    if merge_facts(load, batch, loaded_at, staged):
        load.publish(loaded_at)


def merge_facts(load: Load, batch: DataFrame, loaded_at: datetime, staged: bool = False) -> list[int]:
    """Insert unseen order lines, overwrite known ones in all columns of the batch, keep the rest.

    Only the month partitions that hold a batch key, before or after, are rewritten, into folders of this load;
    they are returned. Where a key is stored is looked up in the key index, whose touched buckets alone are read. A
    known line keeps its load time.

    A batch that breaks a declared constraint of the fact, such as a missing or
    repeated key, is refused whole. The batch is read several times: it is staged first, unless the caller says
    that it already comes from a staged table.
    """
    spark = batch.sparkSession
    dated = schemas.conform(batch, FACT, OPTIONAL).withColumn(MONTH, F.floor(F.col("id_date") / 100).cast("int"))
    incoming = dated if staged else stage(dated, "lot")
    rules = [r for r in quality.CONSTRAINTS[FACT] if r.column in incoming.columns]
    keys = incoming.select(KEY, MONTH)
    # Nothing is visible before the load is published, so a batch may be checked while it is written.
    written = side_by_side(
        spark,
        {
            "check": lambda: quality.require(quality.check_table(incoming, FACT, rules)),
            "write": lambda: (_extend if FACT in load.base.parts else _begin)(load, incoming, keys, loaded_at),
        },
    )
    merge_lots(load, KEY, MONTH, f", {LOADED} timestamp_ntz")
    return written["write"]


def _begin(load: Load, incoming: DataFrame, keys: DataFrame, loaded_at: datetime) -> list[int]:
    """The first sales of a root."""
    months, time = sorted(_counted(keys, MONTH)), _time(loaded_at)
    rows = _stored_columns(incoming.withColumns({**_defaults(incoming), LOADED: time}))
    timed = keys.withColumn(LOADED, time)
    work = {"sales": lambda: load.rewrite(FACT, rows, MONTH, months), "keys": lambda: add_lot(load, timed, KEY, MONTH)}
    side_by_side(load.spark, work)
    return months


def _extend(load: Load, incoming: DataFrame, keys: DataFrame, loaded_at: datetime) -> list[int]:
    """Merge into stored sales; returns the months before and after of all batch keys."""
    time = _time(loaded_at)
    known = keys.withColumns({BEFORE: F.col(MONTH), LOADED: time}).limit(0)
    if load.base.lots:
        there = keys.withColumnRenamed(MONTH, AFTER)
        found = located(load.spark, load.root, load.base, there, KEY, f"{MONTH} int, {LOADED} timestamp_ntz")
        known = stage(found.select(KEY, F.col(AFTER).alias(MONTH), F.col(MONTH).alias(BEFORE), LOADED), "connues")
    coming, leaving = _counted(keys, MONTH), _counted(known, BEFORE)
    touched = sorted(coming.keys() | leaving.keys())
    if not touched:
        return []
    old = read_facts(load.spark, load.root, load.base, sorted(leaving))
    defaults = _defaults(incoming)
    if defaults:
        incoming = _completed(incoming, old, defaults)
    if not known.filter(F.col(LOADED).isNull()).isEmpty():  # lots of an index that kept months alone
        times = old.select(KEY, F.col(LOADED).alias("_temps"))
        known = stage(known.join(times, KEY).withColumn(LOADED, F.coalesce(LOADED, "_temps")).drop("_temps"), "connues")
    merged = _merge(load, incoming, known, coming, leaving, time)
    changed = known.filter(F.col(MONTH) != F.col(BEFORE)).select(KEY, MONTH, LOADED)
    if sum(leaving.values()) < sum(coming.values()):
        # Known keys are as many as the batch may have, however small their file: they are not sent through the driver.
        unseen = keys.join(known.select(KEY).hint("merge"), KEY, "left_anti") if leaving else keys
        changed = changed.unionByName(unseen.withColumn(LOADED, time))
    work = {
        "sales": lambda: load.rewrite(FACT, merged, MONTH, touched, True),
        "keys": lambda: add_lot(load, changed, KEY, MONTH),
    }
    side_by_side(load.spark, work)
    return touched


def _time(loaded_at: datetime) -> Column:
    return F.lit(loaded_at.isoformat(" ")).cast("timestamp_ntz")


def _counted(rows: DataFrame, month: str) -> dict[int, int]:
    return {r[0]: r[1] for r in rows.groupBy(month).count().collect()}  # one row a month


def _stored_columns(df: DataFrame) -> DataFrame:
    fields = [field.split(maxsplit=1) for field in f"{STORED}, {MONTH} int".split(", ")]
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])


def _defaults(batch: DataFrame) -> dict[str, Column]:
    return {c: F.lit(value) for c, value in OPTIONAL.items() if c not in batch.columns}


def _completed(incoming: DataFrame, old: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """The batch with the columns it leaves out: those of its known lines, and the values of a new line."""
    held = old.select(KEY, *[F.col(c).alias(f"_ancien_{c}") for c in defaults], F.lit(True).alias("_connu"))
    given = {c: F.when(F.col("_connu"), F.col(f"_ancien_{c}")).otherwise(default) for c, default in defaults.items()}
    return incoming.join(held, KEY, "left").withColumns(given).select(*incoming.columns, *defaults)


def _merge(load: Load, incoming: DataFrame, known: DataFrame, coming: dict[int, int], leaving: dict[int, int], time: Column) -> DataFrame:
    """All sales of the touched months, placed by month and, where a month is too large for one task, part of its keys.

    Every row goes straight to its month. Known keys send a row without measures ahead: the load time to the month that gets the line, and
    a mark to the one that loses it. Stored sales are only read for months that keep some: where the batch has as many keys of a
    month as there are, every one of them is given anew, since keys are unique on both sides.
    """
    stored = _counted(read_facts(load.spark, load.root, load.base, sorted(coming.keys() | leaving.keys())), MONTH)
    kept = sorted(month for month, n in stored.items() if n > leaving.get(month, 0))
    rows = {month: coming.get(month, 0) + stored.get(month, 0) * (month in kept) for month in coming.keys() | leaving.keys()}
    parts = F.create_map(*[F.lit(v) for month, n in sorted(rows.items()) for v in (month, max(1, -(-n // ROWS_PER_TASK)))])

    gone = known.filter(F.col(BEFORE).isin(kept) & (F.col(BEFORE) != F.col(MONTH)))
    marks = known.select(KEY, MONTH, LOADED).unionByName(gone.select(KEY, F.col(BEFORE).alias(MONTH), LOADED))
    together = _stored_columns(incoming.withColumn(LOADED, F.lit(None))).withColumn("_sorte", F.lit("lot"))
    together = together.unionByName(marks.withColumn("_sorte", F.lit("marque")), allowMissingColumns=True)
    if kept:
        old = _stored_columns(read_facts(load.spark, load.root, load.base, kept))
        together = together.unionByName(old.withColumn("_sorte", F.lit("ancien")))
    placed = together.withColumn("_part", F.pmod(F.hash(KEY), parts[F.col(MONTH)])).repartition(MONTH, "_part")
    line = Window.partitionBy(MONTH, "_part", KEY)
    is_new, is_old = F.col("_sorte") == "lot", F.col("_sorte") == "ancien"
    judged = placed.withColumns({"_charge": F.max(LOADED).over(line), "_donnee": F.max(~is_old).over(line)})
    lines = judged.filter(is_new | (is_old & ~F.col("_donnee")))
    return _stored_columns(lines.withColumn(LOADED, F.when(is_new, F.coalesce("_charge", time)).otherwise(F.col(LOADED))))

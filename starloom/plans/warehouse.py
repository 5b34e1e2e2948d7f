"""The whole run: sources, cleaning, star, load, checks, reports."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import quality
from starloom.operators.cities import city_lookup
from starloom.operators.clients import clean_clients
from starloom.operators.lookup import sized
from starloom.operators.orders import clean_orders
from starloom.operators.products import clean_products
from starloom.operators.segments import client_segments
from starloom.operators.versions import extend_keys, merge_versions, one_per_key
from starloom.plans import dimensions, facts, integrity, reports
from starloom.plans.month_checks import sales_report, update_checks
from starloom.session import scratch_path, side_by_side, stage
from starloom.settings import Settings
from starloom.sinks.generations import Generation, Load, current, read_parts, read_whole
from starloom.sinks.tables import publish_csv
from starloom.sinks.upsert import FACT, merge_facts, read_facts
from starloom.sources.files import read_published

# Versioned dimensions: stem of the key columns, and the attributes whose change opens a version.
KEYS = {"dim_produit": "id_produit", "dim_client": "id_client"}
TRACKED = {
    "dim_produit": ["categorie", "sous_categorie"],
    "dim_client": ["ville", "region_admin", "segment_client"],
}


class Warehouse:
    """The tables of one run, each built once, staged as Parquet and then reread.

    sources offers orders(), clients(), products() and regions(). stored holds
    the dimensions of an earlier run: known natural keys keep their surrogate
    keys, so that loaded sales stay with their clients, products and cities.
    """

    def __init__(
        self, spark: SparkSession, sources, settings: Settings = Settings(), stored: dict[str, DataFrame] | None = None
    ):
        self.spark = spark
        self.sources = sources
        self.settings = settings
        self.stored = stored or {}
        self.checks: list[Row] = []  # rules passed by the last load, one row each

    @cached_property
    def regions(self) -> DataFrame:
        return stage(self.sources.regions(), "regions")

    @cached_property
    def cities(self) -> DataFrame:
        return stage(city_lookup(self.regions), "villes")

    @cached_property
    def orders(self) -> DataFrame:
        """Cleaned orders, what the segments, the courier dimension and the fact read of them: the rest is neither shuffled nor written."""
        return stage(clean_orders(self.sources.orders(), self.cities, self.settings).select(*facts.ORDER_COLUMNS), "commandes")

    @cached_property
    def clients(self) -> DataFrame:
        return clean_clients(self.sources.clients(), self.cities, self.settings)

    @cached_property
    def products(self) -> DataFrame:
        return clean_products(self.sources.products())

    @cached_property
    def segments(self) -> DataFrame:
        return client_segments(self.orders, self.settings)

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        """The five dimensions. What does not depend on the orders is built while they are cleaned."""
        self.cities  # noqa: B018  built before the jobs that share it
        first = self._staged(
            {
                "dim_temps": lambda: dimensions.calendar_dimension(self.spark, self.settings),
                "dim_produit": lambda: self._versioned(
                    "dim_produit", dimensions.product_dimension(self.products, self.settings)
                ),
                "dim_region": lambda: self._extended(dimensions.region_dimension(self.regions, self.settings)),
            },
            orders=lambda: self.orders,
        )
        second = self._staged(
            {
                "dim_client": lambda: self._versioned(
                    "dim_client",
                    dimensions.client_dimension(self.clients, self.segments, self.regions, self.settings),
                ),
                "dim_livreur": lambda: dimensions.courier_dimension(self.orders, self.stored.get("dim_livreur")),
            }
        )
        built = {**first, **second}
        return {name: built[name] for name in schemas.DIMENSIONS}

    def _versioned(self, name: str, built: DataFrame) -> DataFrame:
        """built, or the stored versions brought up to date with it."""
        if name not in self.stored:
            return built
        sk, nk = f"{KEYS[name]}_sk", f"{KEYS[name]}_nk"
        return merge_versions(self.stored[name], one_per_key(built, sk, nk), sk, nk, TRACKED[name], self.settings.as_of)

    def _extended(self, built: DataFrame) -> DataFrame:
        stored = self.stored.get("dim_region")
        return built if stored is None else extend_keys(stored, built, "id_region", "ville")

    def _staged(self, tables: dict[str, Callable[[], DataFrame]], **others: Callable) -> dict[str, DataFrame]:
        """Build and stage tables side by side."""
        work = {name: lambda n=name, build=build: stage(build(), n) for name, build in tables.items()}
        return side_by_side(self.spark, {**others, **work})

    @cached_property
    def rows(self) -> dict[str, int]:
        return table_sizes(self.spark, self.dimensions)

    @cached_property
    def fact(self) -> DataFrame:
        built = stage(facts.sales_fact(self.orders, self.dimensions, self.rows, self.settings), "fait_ventes")
        quality.require(quality.check_table(built, "fait_ventes", quality.FACT_ASSERTIONS))
        return built

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return {**self.dimensions, "fait_ventes": self.fact}

    @cached_property
    def _reports(self) -> dict[str, DataFrame]:
        return {}

    def report(self, name: str) -> DataFrame:
        """A reporting table, materialized on first use."""
        if name not in self._reports:
            self._reports[name] = stage(reports.REPORTS[name](self.star, self.rows, self.settings), name)
        return self._reports[name]

    def load_csv(self, folder: str) -> dict[str, str]:
        """Publish the star as CSV, read it back typed, and check it."""
        paths = publish_csv(self.star, folder)
        self.checks = quality.require(check_published(self.spark, folder))
        return paths

    def load_tables(self, folder: str, loaded_at: datetime) -> Generation:
        """Store the dimensions, merge the sales, check them, bring the reports up to date, and publish all at once.

        A folder that holds dimensions takes only a warehouse built on them. Readers see the generation before until the last
        step; after a failure at any step, run again.
        """
        load = Load(self.spark, folder)
        if not self.stored and load.base.tables:
            raise ValueError(f"{folder} holds dimensions: build the warehouse with stored=stored_dimensions(spark, folder)")
        side_by_side(self.spark, {n: lambda n=n, df=df: load.replace(n, df) for n, df in self.dimensions.items()})
        touched = merge_facts(load, self.fact, loaded_at, staged=True)
        star = star_of(self.spark, load.root, load.next)
        done = side_by_side(
            self.spark,
            {
                "checks": lambda: _check(load, {name: star[name] for name in schemas.DIMENSIONS}),
                "reports": lambda: update_reports(load, self.rows, touched, self.settings),
            },
        )
        self.checks = done["checks"]
        load.publish(loaded_at)
        return load.next


def _check(load: Load, loaded: dict[str, DataFrame]) -> list[Row]:
    """The rules of a load on its dimensions, and on its sales by the results stored for each month."""
    update_checks(load)
    sales = sales_report(load.spark, load.root, load.next, quality.WAREHOUSE_RULES[FACT])
    return quality.require(quality.check_star(loaded, quality.WAREHOUSE_RULES, skip_empty=True).unionByName(sales))


def update_reports(load: Load, rows: dict[str, int], touched: list[int] | None, settings: Settings = Settings()) -> None:
    """The reporting tables of a load, from its own star.

    touched are the months whose sales the load has changed: only the periods that hold them are
    aggregated and written again. A report is built whole where it is not stored yet, where touched is None, or
    where an attribute it shows has changed in a stored row of a dimension.
    """
    star = star_of(load.spark, load.root, load.next)
    shown = {(table, columns) for tables in reports.SHOWN.values() for table, columns in tables.items()}
    work = {key: lambda key=key: _attributes_changed(load, *key, rows[key[0]], settings) for key in sorted(shown)}
    changed = side_by_side(load.spark, work) if touched is not None and load.base.tables else {}

    def update(name: str) -> None:
        whole = touched is None or name not in load.base.parts or any(changed.get(key, True) for key in reports.SHOWN[name].items())
        if whole:
            periods, sales = list(load.next.parts.get(name, {})), star[FACT]
        else:
            periods = sorted({reports.period_of(name, month) for month in touched})
            months = [m for m in load.next.parts[FACT] if reports.period_of(name, m) in periods]
            sales = read_facts(load.spark, load.root, load.next, months).select(*schemas.columns_of(FACT))
        if whole or periods:
            built = reports.REPORTS[name]({**star, FACT: sales}, rows, settings)
            load.rewrite(name, built.withColumn(reports.PART, reports.period_column(name)), reports.PART, periods)

    side_by_side(load.spark, {name: lambda name=name: update(name) for name in reports.REPORTS})


def _attributes_changed(load: Load, table: str, columns: tuple[str, ...], rows: int, settings: Settings) -> bool:
    """Whether a stored row of a dimension, of so many rows, shows other attributes in this load, or is gone. The first column is the key.

    New days count, too: sales may be stored that lay outside the calendar.
    """
    old, new = (read_whole(load.spark, load.root, held, table) for held in (load.base, load.next))
    if old is None or (table == "dim_temps" and old.count() != new.count()):
        return True
    named = new.select(*[F.col(c).alias(f"_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns[1:]]
    key = F.col(columns[0]) == F.col(f"_{columns[0]}")
    return not old.select(*columns).join(sized(named, rows, settings.broadcast_rows), [key, *same], "left_anti").isEmpty()


def star_of(spark: SparkSession, root: str, held: Generation) -> dict[str, DataFrame]:
    """The six tables of one generation."""
    star = {name: read_whole(spark, root, held, name) for name in schemas.DIMENSIONS}
    return {**star, FACT: read_facts(spark, root, held).select(*schemas.columns_of(FACT))}


def stored_dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The dimensions an earlier run left in a folder."""
    root = folder.rstrip("/")
    held = current(spark, root)
    return {name: read_whole(spark, root, held, name) for name in schemas.DIMENSIONS if name in held.tables}


def stored_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A reporting table as it was published last."""
    root = folder.rstrip("/")
    return read_parts(spark, root, current(spark, root), name, reports.PART).drop(reports.PART)


def table_sizes(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of stored tables, from the Parquet footers."""
    return side_by_side(spark, {name: df.count for name, df in tables.items()})


def refresh_reports(spark: SparkSession, folder: str, refreshed_at: datetime, settings: Settings = Settings()) -> None:
    """Build the reporting tables of a folder whole, from its stored star, and publish them."""
    load = Load(spark, folder)
    update_reports(load, table_sizes(spark, star_of(spark, load.root, load.next)), None, settings)
    load.publish(refreshed_at)


def check_published(spark: SparkSession, folder: str) -> DataFrame:
    """The load rules on every published CSV table found in a folder."""
    return quality.check_star(read_published(spark, folder), quality.LOAD_RULES)


def check_load(spark: SparkSession, folder: str) -> DataFrame:
    """Failures of every declared constraint and foreign key on the stored tables, one row each."""
    star = stored_star(spark, folder)
    constraints = quality.check_star(star, quality.CONSTRAINTS, skip_empty=True).select(
        F.concat_ws(" ", "table_name", "colonne", "regle").alias("check_name"), F.col("echecs").alias("nb_echecs")
    )
    orphans = integrity.orphan_keys(star).withColumnRenamed("nb_orphelines", "nb_echecs")
    return constraints.unionByName(orphans)


def stored_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables of a loaded warehouse, all of the generation published last."""
    root = folder.rstrip("/")
    return star_of(spark, root, current(spark, root))


def run(
    spark: SparkSession,
    sources,
    folder: str | None = None,
    settings: Settings = Settings(),
    loaded_at: datetime | None = None,
    as_tables: bool = True,
) -> Warehouse:
    """Build and load everything; folder defaults to a new scratch path.

    Tables are added to those that earlier runs stored in the folder. They, the reporting tables of all stored
    sales included, are published as one generation.
    """
    target = folder or scratch_path(spark, "entrepot")
    warehouse = Warehouse(spark, sources, settings, stored_dimensions(spark, target) if as_tables else None)
    if as_tables:
        warehouse.load_tables(target, loaded_at or datetime.now())
    else:
        warehouse.load_csv(target)
    return warehouse

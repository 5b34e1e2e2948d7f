"""Every query by name, over one folder of retail tables.

Rules run on the raw frames. What the business reads from stored tables
(dimensions, fact, reporting tables) is built once per session and folder and
then reread, as it would be in a scheduled run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, ShortType

from starloom import schemas
from starloom.functions.dates import parse_date
from starloom.operators import clients, orders, quality
from starloom.operators.cities import city_lookup
from starloom.operators.lookup import attach_by_key, hot_keys
from starloom.operators.products import clean_products
from starloom.operators.segments import client_segments
from starloom.operators.surrogate import assign_keys
from starloom.operators.versions import merge_versions, one_per_key
from starloom.plans import audit, dimensions, facts, integrity, month_checks, questions, reports
from starloom.plans.warehouse import KEYS, TRACKED, Warehouse, check_load, run, star_of, stored_report, stored_star, table_sizes, update_reports
from starloom.session import fit_to_rows, scratch_path, stage
from starloom.settings import Settings
from starloom.sinks.generations import Load, current, generations, read_parts
from starloom.sinks.tables import publish_csv, replace_table, write_csv
from starloom.sinks.upsert import LOADED, MONTH, merge_facts, read_stored, upsert_facts
from starloom.sources import files
from starloom.sources.retail_tables import RetailTables
from starloom.streaming.arrivals import load_arrivals, stream_facts
from starloom.streaming.orders import load_orders

# Thresholds on the scale of the benchmark tables' amounts.
SETTINGS = Settings(
    gold_from=Decimal("6000000"),
    silver_from=Decimal("2000000"),
    red_above=Decimal("54"),
    orange_above=Decimal("50"),
    top_city="NATION_1",
    period_category="Economy",
)
FIRST_LOAD = datetime(2026, 6, 1)
SECOND_LOAD = datetime(2026, 6, 2)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_warehouses: dict[tuple[str, str], Warehouse] = {}
_line_counts: dict[tuple[str, str], int] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, RetailTables(spark, folder), SETTINGS)
    return _warehouses[key]


def _plain(df: DataFrame) -> DataFrame:
    """Report-edge types: DECIMAL as DOUBLE, SMALLINT as INT, DATE as ISO text, the delay, often null, as DOUBLE."""
    edge = {DecimalType: "double", ShortType: "int", DateType: "string"}

    def plain(field):
        kind = "double" if field.name == "delai_livraison_jours" else edge.get(type(field.dataType))
        return F.col(field.name).cast(kind).alias(field.name) if kind else F.col(field.name)

    return df.select(*[plain(f) for f in df.schema])


def _query(function: Query) -> Query:
    def query(spark, folder):
        fit_to_rows(spark, _lines(spark, folder))
        return _plain(function(spark, folder))

    QUERIES[function.__name__] = query
    return function


def _lines(spark: SparkSession, folder: str) -> int:
    """Rows of the largest table, from its footers once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _line_counts:
        _line_counts[key] = RetailTables(spark, folder).table("lineitem").count()
    return _line_counts[key]


# Sources ---------------------------------------------------------------------


@_query
def src_csv_text(spark, folder):
    """Raw orders written as CSV and read back as text."""
    raw = RetailTables(spark, folder).orders().drop(schemas.ARRIVAL)
    path = write_csv(raw, "commandes", scratch_path(spark, "csv"))
    return files.read_orders(spark, path).drop(schemas.ARRIVAL)


@_query
def src_csv_clients(spark, folder):
    """Raw clients written as CSV and read back as text."""
    path = write_csv(RetailTables(spark, folder).clients().drop(schemas.ARRIVAL), "clients", scratch_path(spark, "csv"))
    return files.read_clients(spark, path).drop(schemas.ARRIVAL)


@_query
def src_csv_regions(spark, folder):
    """The region list written as CSV and read back as text."""
    path = write_csv(RetailTables(spark, folder).regions().drop(schemas.ARRIVAL), "regions", scratch_path(spark, "csv"))
    return files.read_regions(spark, path).drop(schemas.ARRIVAL)


@_query
def src_json_explode(spark, folder):
    """Products written as {"produits": [...]} documents of at most 1000 items and read back."""
    raw = RetailTables(spark, folder).products()
    items = F.struct(*schemas.PRODUCT_COLUMNS)
    documents = raw.groupBy(F.floor(F.col(schemas.ARRIVAL) / 1000)).agg(F.collect_list(items).alias("produits"))
    path = scratch_path(spark, "json")
    documents.select("produits").write.option("ignoreNullFields", False).json(path)
    return files.read_products(spark, path).drop(schemas.ARRIVAL)


def _array_documents(batches):
    """One {"produits": [...]} document a task, of any length, an item a line."""
    yield pd.DataFrame({"value": ['{"produits": [']})
    separator = " "
    for batch in batches:
        lines = [separator, *[", "] * (len(batch) - 1)] if len(batch) else []
        yield pd.DataFrame({"value": [a + b for a, b in zip(lines, batch["value"], strict=True)]})
        separator = ", " if len(batch) else separator
    yield pd.DataFrame({"value": ["]}"]})


@_query
def src_json_array(spark, folder):
    """Products as few long arrays, names with braces, quotes and backslashes, cut at items and read by many tasks."""
    odd = F.concat("nom", F.lit(' }{ "\\ ]} '), "id_produit")
    raw = RetailTables(spark, folder).products().withColumn("nom", odd)
    items = F.to_json(F.struct(*schemas.PRODUCT_COLUMNS), {"ignoreNullFields": "false"})
    path = scratch_path(spark, "json")
    raw.select(items.alias("value")).mapInPandas(_array_documents, "value string").write.text(path)
    return files.read_products(spark, path).drop(schemas.ARRIVAL)


@_query
def src_csv_quoted(spark, folder):
    """Clients whose names hold line breaks, quotes and separators, written as CSV and read back by many tasks."""
    odd = F.concat("nom", F.lit('\n"dit, \n\n'), "prenom", F.lit('"\n'))
    raw = RetailTables(spark, folder).clients().withColumn("nom", odd).drop(schemas.ARRIVAL)
    path = write_csv(raw, "clients", scratch_path(spark, "csv"))
    return files.read_clients(spark, path, multi_line=True).drop(schemas.ARRIVAL)


# Order rules -----------------------------------------------------------------


def _raw_orders(spark, folder):
    return RetailTables(spark, folder).orders()


@_query
def city_lookup_(spark, folder):
    return city_lookup(RetailTables(spark, folder).regions())


@_query
def dedup_orders_last(spark, folder):
    return orders.latest_orders(_raw_orders(spark, folder)).drop(schemas.ARRIVAL)


@_query
def clean_dates(spark, folder):
    dated = orders.standardize_dates(_raw_orders(spark, folder))
    return dated.select("id_commande", "date_commande", "date_livraison")


@_query
def clean_cities(spark, folder):
    cities = warehouse(spark, folder).cities
    return orders.standardize_delivery_city(_raw_orders(spark, folder), cities).select("id_commande", "ville_livraison")


@_query
def clean_status(spark, folder):
    return orders.standardize_status(_raw_orders(spark, folder)).select("id_commande", "statut")


@_query
def clean_quantity(spark, folder):
    return orders.keep_positive_quantity(_raw_orders(spark, folder)).select("id_commande", "quantite")


@_query
def clean_test_orders(spark, folder):
    return orders.drop_test_orders(_raw_orders(spark, folder)).select("id_commande", "prix_unitaire")


@_query
def clean_courier(spark, folder):
    return orders.mark_missing_courier(_raw_orders(spark, folder)).select("id_commande", "id_livreur")


@_query
def order_amounts(spark, folder):
    valid = _raw_orders(spark, folder).transform(orders.keep_positive_quantity).transform(orders.drop_test_orders)
    return orders.add_amounts(valid, SETTINGS).select("id_commande", "montant_ht", "montant_ttc")


@_query
def delivery_delay(spark, folder):
    ready = _raw_orders(spark, folder).transform(orders.standardize_dates).transform(orders.standardize_status)
    return orders.add_delivery_delay(ready, SETTINGS).select("id_commande", "statut", "delai_livraison_jours")


@_query
def clean_orders_all(spark, folder):
    cities = warehouse(spark, folder).cities
    return orders.clean_orders(_raw_orders(spark, folder), cities, SETTINGS).drop(schemas.ARRIVAL)


@_query
def rule_audit(spark, folder):
    w = warehouse(spark, folder)
    return audit.rule_audit(w.sources.orders(), w.sources.clients(), w.sources.products(), w.cities, SETTINGS)


# Client and product rules ----------------------------------------------------


def _raw_clients(spark, folder):
    return RetailTables(spark, folder).clients()


@_query
def dedup_clients_email(spark, folder):
    return clients.latest_by_email(_raw_clients(spark, folder)).select("id_client", "email_norm", "date_inscription")


@_query
def clean_sex(spark, folder):
    return clients.standardize_sex(_raw_clients(spark, folder)).select("id_client", "sexe")


@_query
def clean_birthdate_ageband(spark, folder):
    checked = clients.validate_birth_date(_raw_clients(spark, folder), SETTINGS)
    return checked.select("id_client", "date_naissance", "age", "tranche_age")


@_query
def clean_email(spark, folder):
    return clients.validate_email(_raw_clients(spark, folder)).select("id_client", "email")


@_query
def clean_client_cities(spark, folder):
    cities = warehouse(spark, folder).cities
    return clients.standardize_home_city(_raw_clients(spark, folder), cities).select("id_client", "ville")


@_query
def clean_clients_all(spark, folder):
    cities = warehouse(spark, folder).cities
    return clients.clean_clients(_raw_clients(spark, folder), cities, SETTINGS).drop(schemas.ARRIVAL)


@_query
def clean_products_(spark, folder):
    return clean_products(RetailTables(spark, folder).products()).drop(schemas.ARRIVAL)


@_query
def client_segments_(spark, folder):
    return client_segments(warehouse(spark, folder).orders, SETTINGS)


# Star ------------------------------------------------------------------------


@_query
def surrogate_keys(spark, folder):
    """Dense keys over all orders, by date."""
    heads = RetailTables(spark, folder).table("orders").select("o_orderkey", "o_orderdate")
    return assign_keys(heads, [F.col("o_orderdate"), F.col("o_orderkey")], "cle").select("o_orderkey", "cle")


@_query
def dim_temps(spark, folder):
    """The calendar with the number of sales of each day."""
    w = warehouse(spark, folder)
    sales = w.fact.groupBy("id_date").agg(F.count("*").alias("_n"))
    return w.dimensions["dim_temps"].join(sales, "id_date", "left").select(
        *schemas.columns_of("dim_temps"), F.coalesce("_n", F.lit(0)).alias("nb_lignes")
    )


@_query
def dim_produit(spark, folder):
    return dimensions.product_dimension(warehouse(spark, folder).products, SETTINGS)


@_query
def dim_client(spark, folder):
    w = warehouse(spark, folder)
    return dimensions.client_dimension(w.clients, w.segments, w.regions, SETTINGS)


@_query
def dim_region(spark, folder):
    return dimensions.region_dimension(RetailTables(spark, folder).regions(), SETTINGS)


@_query
def dim_livreur(spark, folder):
    return dimensions.courier_dimension(warehouse(spark, folder).orders)


def _resolved(spark, folder, key: facts.KeyMap) -> DataFrame:
    w = warehouse(spark, folder)
    dimension = w.dimensions[key.dimension]
    found = facts.resolve_key(w.orders, dimension, key, w.rows[key.dimension], SETTINGS)
    surrogate = F.col(f"_sk_{key.output}")
    return found.select(
        "id_commande",
        F.col(key.order_column).alias(key.natural),
        F.coalesce(surrogate, facts.fallback_key(key, dimension, SETTINGS)).alias(key.output),
        surrogate.isNull().alias("non_resolu"),
    )


@_query
def fk_product(spark, folder):
    return _resolved(spark, folder, facts.PRODUCT)


@_query
def fk_client(spark, folder):
    return _resolved(spark, folder, facts.CLIENT)


@_query
def fk_region(spark, folder):
    return _resolved(spark, folder, facts.REGION)


@_query
def fk_courier(spark, folder):
    return _resolved(spark, folder, facts.COURIER)


@_query
def fait_ventes(spark, folder):
    w = warehouse(spark, folder)
    return facts.sales_fact(w.orders, w.dimensions, w.rows, SETTINGS)


# The days of two runs, and of a third, back-dated one.
FIRST_RUN, BACK_DATED_RUN, LAST_RUN = date(2021, 1, 1), date(2022, 7, 1), date(2024, 1, 1)


def _with_history(w: Warehouse, names: tuple[str, ...] = tuple(KEYS)) -> dict[str, DataFrame]:
    """The dimensions, those named after three runs, the last of them back-dated, under other limits and other categories."""

    def clients_under(gold: str, silver: str, people: DataFrame) -> DataFrame:
        segments = client_segments(w.orders, replace(SETTINGS, gold_from=Decimal(gold), silver_from=Decimal(silver)))
        return dimensions.client_dimension(people, segments, w.regions, replace(SETTINGS, as_of=FIRST_RUN))

    def products_named(nth: int, ending: str) -> DataFrame:
        renamed = F.when(F.length("nom") % nth == 0, F.concat("categorie", F.lit(ending))).otherwise(F.col("categorie"))
        return dimensions.product_dimension(w.products.withColumn("categorie", renamed), replace(SETTINGS, as_of=FIRST_RUN))

    def client_states():
        signed_up = w.clients.filter(F.col("date_inscription") < F.lit(date(2022, 1, 1)))
        yield None, clients_under("6000000", "2000000", signed_up)
        yield LAST_RUN, clients_under("3000000", "1000000", w.clients)
        yield BACK_DATED_RUN, clients_under("12000000", "4000000", w.clients)

    def product_states():
        yield None, products_named(1, "")
        yield LAST_RUN, products_named(3, " Bis")
        yield BACK_DATED_RUN, products_named(2, " Ter")

    def history(name: str, states) -> DataFrame:
        sk, nk = f"{KEYS[name]}_sk", f"{KEYS[name]}_nk"
        merged = None
        for day, state in states:
            merged = state if day is None else merge_versions(merged, one_per_key(state, sk, nk), sk, nk, TRACKED[name], day)
        return stage(merged, name)

    states = {"dim_client": client_states, "dim_produit": product_states}
    return {**w.dimensions, **{name: history(name, states[name]()) for name in names}}


@_query
def fact_point_in_time(spark, folder):
    """Every sale with the client segment and the product category that were valid on its day, and their bounds."""
    w = warehouse(spark, folder)
    star = _with_history(w)
    sales = facts.sales_fact(w.orders, star, table_sizes(spark, star), replace(SETTINGS, unresolved_sk=-1))
    sales = sales.select("id_commande", "id_date", "id_client", "id_produit")
    for name, attribute in (("dim_client", "segment_client"), ("dim_produit", "categorie")):
        stem = KEYS[name]
        bounds = [F.col(c).alias(f"{c}_{stem[3:]}") for c in ("date_debut", "date_fin")]
        versions = star[name].select(F.col(f"{stem}_sk").alias(stem), f"{stem}_nk", attribute, *bounds)
        sales = sales.join(versions, stem, "left").drop(stem)
    return sales


@_query
def dim_client_history(spark, folder):
    """All versions of every client after three runs, the last of them back-dated."""
    return _with_history(warehouse(spark, folder), ("dim_client",))["dim_client"].select(
        "id_client_nk", "segment_client", "ville", "date_debut", "date_fin", "est_actif"
    )


@_query
def fact_summary(spark, folder):
    return audit.fact_summary(warehouse(spark, folder).fact)


@_query
def fact_assertions(spark, folder):
    return quality.check_table(warehouse(spark, folder).fact, "fait_ventes", quality.FACT_ASSERTIONS)


# Reports ---------------------------------------------------------------------


def _report(name: str, build) -> None:
    def query(spark, folder):
        w = warehouse(spark, folder)
        return build(w.star, w.rows, SETTINGS)

    query.__name__ = name
    _query(query)


_report("mv_monthly_revenue", reports.monthly_revenue)
_report("mv_top_products", reports.top_products)
_report("mv_return_rate", reports.return_rate)
_report("mv_courier_performance", reports.courier_performance)


@_query
def clients_by_period(spark, folder):
    """Distinct clients by city and month, quarter and year, from one stored table."""
    return reports.clients_by_period(warehouse(spark, folder).report("mv_clients"))


@_query
def q1_monthly_revenue_yoy(spark, folder):
    return questions.revenue_vs_last_year(warehouse(spark, folder).report("mv_ca_mensuel"))


@_query
def q2_top10_products_city(spark, folder):
    return questions.top_products_in_city(warehouse(spark, folder).report("mv_top_produits"), SETTINGS)


@_query
def q3_basket_by_segment(spark, folder):
    w = warehouse(spark, folder)
    return questions.basket_by_segment(w.star, w.rows, SETTINGS)


@_query
def q4_return_rate(spark, folder):
    return questions.return_rate_by_class(warehouse(spark, folder).report("mv_taux_retour"), SETTINGS)


@_query
def q5_period_effect(spark, folder):
    return questions.period_effect(warehouse(spark, folder).report("mv_ca_mensuel"), SETTINGS)


# Integrity and quality -------------------------------------------------------


@_query
def table_counts(spark, folder):
    return integrity.table_counts(warehouse(spark, folder).star)


@_query
def orphan_keys(spark, folder):
    return integrity.orphan_keys(warehouse(spark, folder).star)


@_query
def measure_anomalies(spark, folder):
    return integrity.measure_anomalies(warehouse(spark, folder).fact)


@_query
def status_distribution(spark, folder):
    return integrity.status_distribution(warehouse(spark, folder).fact)


@_query
def scd2_active_uniqueness(spark, folder):
    return integrity.active_version_conflicts(warehouse(spark, folder).dimensions)


@_query
def kpi_summary(spark, folder):
    return integrity.headline_figures(warehouse(spark, folder).fact)


@_query
def dq_report(spark, folder):
    return quality.check_star(warehouse(spark, folder).star, quality.LOAD_RULES)


@_query
def dq_table_score(spark, folder):
    return quality.table_scores(quality.check_star(warehouse(spark, folder).star, quality.LOAD_RULES))


@_query
def dq_constraints(spark, folder):
    return quality.check_star(warehouse(spark, folder).star, quality.CONSTRAINTS)


# Loads -----------------------------------------------------------------------


@_query
def sink_roundtrip(spark, folder):
    """All tables published as CSV; the fact read back with its declared types."""
    paths = publish_csv(warehouse(spark, folder).star, scratch_path(spark, "publie"))
    return files.read_published_csv(spark, paths["fait_ventes"], "fait_ventes")


@_query
def dim_replace(spark, folder):
    """The client dimension loaded under other segment limits, then replaced."""
    w = warehouse(spark, folder)
    path = scratch_path(spark, "dim_client")
    replace_table(_client_dimension_with(w, Decimal("3000000"), Decimal("1000000")), path)
    replace_table(w.dimensions["dim_client"], path)
    return files.read_table(spark, path, "dim_client")


def _client_dimension_with(w: Warehouse, gold: Decimal, silver: Decimal) -> DataFrame:
    limits = replace(SETTINGS, gold_from=gold, silver_from=silver)
    return dimensions.client_dimension(w.clients, client_segments(w.orders, limits), w.regions, limits)


def _history(fact: DataFrame) -> DataFrame:
    """What the first load brings: all sales up to mid 2025."""
    return fact.filter("id_date < 20250701")


def _corrections(fact: DataFrame) -> DataFrame:
    """What the second load brings: all sales of 2025 on, some corrected, some moved to another month."""
    status = F.col("statut_commande")
    return fact.filter("id_date >= 20250101").withColumns(
        {
            "id_date": F.when(status == "inconnu", 20251201).otherwise(F.col("id_date")),
            "statut_commande": F.when(status == "en_cours", "livré").otherwise(status),
        }
    )


def _stored_fact(spark, path):
    return read_stored(spark, path).drop(MONTH).withColumn(LOADED, F.col(LOADED).cast("date"))


def _loaded(spark, folder, times: int) -> DataFrame:
    fact = warehouse(spark, folder).fact
    path = scratch_path(spark, "faits")
    upsert_facts(_history(fact), path, FIRST_LOAD, staged=True)
    for _ in range(times):
        upsert_facts(_corrections(fact), path, SECOND_LOAD, staged=True)
    return _stored_fact(spark, path)


@_query
def fact_upsert(spark, folder):
    return _loaded(spark, folder, times=1)


@_query
def fact_upsert_idempotent(spark, folder):
    return _loaded(spark, folder, times=2)


def _two_loads(spark, folder, complete=lambda load, w, touched: update_reports(load, w.rows, touched, SETTINGS)) -> str:
    """Two published loads of one root, reports included, and a third that ended before it was published."""
    w = warehouse(spark, folder)
    root = scratch_path(spark, "entrepot")
    lost = w.fact.withColumn("id_date", F.lit(20250101))
    for number, (batch, day) in enumerate(((_history(w.fact), FIRST_LOAD), (_corrections(w.fact), SECOND_LOAD), (lost, SECOND_LOAD))):
        load = Load(spark, root)
        for name, df in w.dimensions.items():
            load.replace(name, df)
        touched = merge_facts(load, batch, day, staged=True)
        if number < 2:
            complete(load, w, touched)
            load.publish(day)
    return root


@_query
def load_generations(spark, folder):
    """Sales and reports as readers of each generation see them, after a load that was never published."""
    root = _two_loads(spark, folder)
    lines = []
    for held in generations(spark, root, 2):
        sales = star_of(spark, root, held)["fait_ventes"].agg(
            F.lit(held.number).alias("generation"), F.count("*").alias("nb_ventes"), F.sum("quantite_vendue").alias("quantite"),
            F.countDistinct(F.floor(F.col("id_date") / 100)).alias("nb_mois"),
        )
        report = read_parts(spark, root, held, "mv_ca_mensuel", reports.PART).agg(F.sum("volume_vendu").alias("volume_vendu"))
        lines.append(sales.crossJoin(report))  # one row each
    return reduce(DataFrame.unionByName, lines)


@_query
def reports_incremental(spark, folder):
    """Every row of the four reports after a second load that wrote only the periods it touched, by its measures."""
    root = _two_loads(spark, folder)
    measures = {
        "mv_ca_mensuel": ("categorie", "volume_vendu", "nb_clients_actifs"), "mv_top_produits": ("nom_produit", "qte_totale", "rang_global"),
        "mv_taux_retour": ("sous_categorie", "nb_livrees", "nb_retournees"),
        "mv_performance_livreurs": ("nom_livreur", "nb_livraisons", "nb_livraisons_retard"),
    }
    lines = [
        stored_report(spark, root, name).select(
            F.lit(name).alias("table_name"), reports.period_column(name).alias("periode"), F.col(label).alias("libelle"),
            *[F.col(c).cast("long").alias(a) for c, a in ((first, "mesure_1"), (second, "mesure_2"))],
        )
        for name, (label, first, second) in measures.items()
    ]
    return reduce(DataFrame.unionByName, lines)


@_query
def checks_incremental(spark, folder):
    """Results of every rule on the sales by month, and of one that late sales break, after a second load that checked only its months."""
    rules = (*month_checks.RULES, quality.between("delai_livraison_jours", high=5))
    root = _two_loads(spark, folder, lambda load, w, touched: month_checks.update_checks(load, rules))
    return month_checks.results_by_month(spark, root, current(spark, root)).drop("cle")


@_query
def fact_upsert_stream(spark, folder):
    """History already loaded; the corrections arrive as files, and once more as new files."""
    fact = warehouse(spark, folder).fact
    path, arrivals, progress = (scratch_path(spark, name) for name in ("faits", "arrivees", "suivi"))
    upsert_facts(_history(fact), path, FIRST_LOAD, staged=True)
    for _ in range(2):
        _corrections(fact).write.mode("append").parquet(arrivals)
        incoming = stream_facts(spark, arrivals)
        load_arrivals(incoming, lambda batch: batch, path, progress, SECOND_LOAD)
    return _stored_fact(spark, path)


class GrowingTables(RetailTables):
    """Sources of a stream: the second batch brings new clients and products."""

    batch = 0

    def clients(self):
        return super().clients().filter((F.length("id_client") % 2 == 0) | F.lit(self.batch > 0))

    def products(self):
        return super().products().filter(F.col("actif") | F.lit(self.batch > 0))


@_query
def orders_stream(spark, folder):
    """Every sale of raw order files that came in two batches, and once more to a stream that had lost its checkpoint."""
    sources = GrowingTables(spark, folder)
    root, arrivals = scratch_path(spark, "entrepot"), scratch_path(spark, "arrivees")
    lines = sources.orders().withColumn("_jour", F.col(f"{schemas.ARRIVAL}.l_shipdate"))
    earlier = F.col("_jour") < F.lit("1998-07-01").cast("date")
    settings = replace(SETTINGS, unresolved_sk=-1)
    for sources.batch, part in enumerate((lines.filter(earlier), lines.filter(~earlier), None)):
        if part is not None:
            # Couriers with an even number come with the second batch only.
            known = F.col("id_livreur").rlike("[02468]$") & F.lit(sources.batch == 0)
            late = part.withColumn("id_livreur", F.when(known, "").otherwise(F.col("id_livreur")))
            # Lines of one order lie in one file in their order of arrival; only their order counts.
            placed = late.repartition("id_commande").sortWithinPartitions(schemas.ARRIVAL, "id_commande")
            ordered = placed.drop("_jour", schemas.ARRIVAL)
            ordered.write.mode("append").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
                "ignoreTrailingWhiteSpace", False
            ).csv(arrivals)
        checkpoint = scratch_path(spark, "suivi") if sources.batch != 1 else checkpoint
        load_orders(files.stream_files(spark, arrivals), sources, root, checkpoint, FIRST_LOAD, settings)
    return _named_sales(spark, root, "id_date", "quantite_vendue", "statut_commande")


def _named_sales(spark, root: str, *measures: str) -> DataFrame:
    """Every stored sale with the natural keys its stored keys stand for."""
    star = stored_star(spark, root)
    rows = table_sizes(spark, {key.dimension: star[key.dimension] for key in facts.KEY_MAPS})
    sales = star["fait_ventes"].select("id_commande", *measures, *[key.output for key in facts.KEY_MAPS])
    limit = SETTINGS.broadcast_rows
    hot = hot_keys(sales, [key.output for key in facts.KEY_MAPS if rows[key.dimension] > limit])
    for key in facts.KEY_MAPS:
        names = star[key.dimension].select(F.col(key.surrogate).alias(key.output), F.col(key.natural))
        sales = attach_by_key(
            sales, names, key.output, F.col("id_commande"), rows[key.dimension], limit, hot.get(key.output)
        ).drop(key.output)
    return sales


@_query
def scd2_merge(spark, folder):
    """The client dimension after a month in which the segment limits were halved."""
    w = warehouse(spark, folder)
    incoming = _client_dimension_with(w, Decimal("3000000"), Decimal("1000000"))
    tracked = [
        "nom_complet", "tranche_age", "sexe", "ville", "region_admin", "segment_client", "canal_acquisition",
    ]
    return merge_versions(
        w.dimensions["dim_client"], incoming, "id_client_sk", "id_client_nk", tracked, date(2026, 7, 1)
    )


@_query
def pipeline_end_to_end(spark, folder):
    """A full run into a new folder: row counts and passed rules of the stored tables."""
    target = scratch_path(spark, "entrepot")
    checks = run(spark, RetailTables(spark, folder), target, SETTINGS, FIRST_LOAD).checks
    scores = quality.table_scores(spark.createDataFrame(checks)).drop("succes")
    counts = integrity.table_counts(stored_star(spark, target))
    return counts.join(F.broadcast(scores), "table_name", "left").select(
        "table_name", "nb_lignes",
        F.coalesce("regles", F.lit(0)).alias("regles"), F.coalesce("regles_ok", F.lit(0)).alias("regles_ok"),
    )


@_query
def load_checks(spark, folder):
    """The declared constraints and the foreign keys, on the stored tables of a full run."""
    target = scratch_path(spark, "entrepot")
    run(spark, RetailTables(spark, folder), target, SETTINGS, FIRST_LOAD)
    return check_load(spark, target)


@_query
def reports_refresh(spark, folder):
    """Rows and a total of each reporting table that a full run stored."""
    target = scratch_path(spark, "entrepot")
    run(spark, RetailTables(spark, folder), target, SETTINGS, FIRST_LOAD)
    totals = {
        "mv_ca_mensuel": "volume_vendu", "mv_top_produits": "qte_totale",
        "mv_taux_retour": "nb_retournees", "mv_performance_livreurs": "nb_livraisons",
    }
    lines = [
        stored_report(spark, target, name).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("nb_lignes"), F.sum(total).alias("total")
        )
        for name, total in totals.items()
    ]
    return reduce(DataFrame.unionByName, lines)


class FirstDelivery(RetailTables):
    """What a first run gets: earlier orders, later clients, active products. The second gets everything."""

    def orders(self):
        return super().orders().filter(parse_date(F.col("date_commande")) < F.lit(date(2023, 7, 1)))

    def clients(self):
        # The optimizer would put a computed date, and its text, in place of every mention, which is more code than the JVM takes.
        read = super().clients().select("*", F.explode(F.array(parse_date(F.col("date_inscription")))).alias("_inscrit"))
        return read.filter(F.col("_inscrit") >= F.lit(date(2022, 1, 1))).drop("_inscrit")

    def products(self):
        return super().products().filter("actif")


class SecondDelivery(RetailTables):
    """All clients and products, and the orders the first run did not get."""

    def orders(self):
        return super().orders().filter(parse_date(F.col("date_commande")) >= F.lit(date(2023, 7, 1)))


@_query
def pipeline_second_run(spark, folder):
    """Every sale of two runs into one folder, with the natural keys its stored keys stand for."""
    target = scratch_path(spark, "entrepot")
    run(spark, FirstDelivery(spark, folder), target, SETTINGS, FIRST_LOAD)
    run(spark, SecondDelivery(spark, folder), target, replace(SETTINGS, as_of=date(2026, 7, 1)), SECOND_LOAD)
    return _named_sales(spark, target)


# Names that would hide an imported function carry a trailing underscore.
QUERIES = {name.rstrip("_"): query for name, query in QUERIES.items()}

"""What of an order line is shuffled while older copies go."""

import re

from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators.orders import clean_orders
from starloom.plans import facts
from starloom.plans.catalogue import warehouse

COLUMNS = ", ".join(f"{c} string" for c in schemas.ORDER_COLUMNS) + f", {schemas.ARRIVAL} long"


def line(key, quantity, price, delivered, arrival, day="2024-03-01", status="livre"):
    return (key, "C1", "P1", day, quantity, price, status, "tng", "1", "", delivered, arrival)


def test_the_star_reads_no_more_of_an_order_than_it_needs(spark, small):
    assert warehouse(spark, small).orders.columns == list(facts.ORDER_COLUMNS)


def test_delays_are_shuffled_in_place_of_delivery_dates(spark):
    raw = spark.createDataFrame([line("a", "1", "2", "2024-03-04", 1)], COLUMNS)
    cities = spark.createDataFrame([("tng", "Tanger")], "variante string, ville string")
    plan = clean_orders(raw, cities).select(*facts.ORDER_COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    shuffled = re.search(r"WindowGroupLimit[^\n]*\n[^\n]*Project \[([^\n]*)\]", plan).group(1)
    assert re.search(r"AS delai_livraison_jours#\d+", shuffled) and not re.search(r"AS date_livraison#|mode_paiement#", shuffled)


def test_an_older_copy_neither_stops_the_run_nor_stands_in(spark):
    cities = spark.createDataFrame([("tng", "Tanger")], "variante string, ville string")
    rows = [
        line("a", "99999999999", "99999999999", "2024-03-04", 1), line("a", "2", "3.5", "2024-03-06", 2, status="DONE"),  # too large an amount
        line("b", "1", "2", "2024-03-04", 1), line("b", "1", "2", "2024-03-04", 2, day="?"),  # the last copy is not dated
        line("c", "1", "2", "2024-03-04", 1), line("c", "0", "2", "2024-03-04", 2),
    ]
    cleaned = clean_orders(spark.createDataFrame(rows, COLUMNS), cities)
    assert cleaned.columns == [*schemas.ORDER_COLUMNS, schemas.ARRIVAL, "montant_ht", "montant_ttc", "delai_livraison_jours"]
    found = cleaned.select("id_commande", F.col("montant_ht").cast("string"), "delai_livraison_jours", "ville_livraison", "statut").collect()
    assert [tuple(r) for r in found] == [("a", "7.00", 5, "Tanger", "livré")]

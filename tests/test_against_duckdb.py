"""Every registered query against its DuckDB statement, on the whole small tables."""

import math
from datetime import date

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_point
from starloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES, ORACLES = catalogue.QUERIES, entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    yield connection
    connection.close()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ""
        return value.isoformat() if isinstance(value, date) else repr(value)

    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) and len(QUERIES) > 50
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    mine = canonical(df.columns, df.collect())
    relation = duck.sql(ORACLES[name])
    theirs = canonical(relation.columns, relation.fetchall())
    assert mine == theirs
    assert mine[1], "no rows"


def test_entry(spark):
    assert entry_point.entry(spark).columns[:2] == ["annee", "mois"]

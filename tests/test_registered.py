"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from queries import check_sql, registered

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")
WITHOUT_SQL = {"k_journeys", "journey_legs", "journey_plan"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_but_the_path_listings_has_sql():
    assert set(registered.queries()) - set(check_sql.check_sql()) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registered.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(check_sql.check_sql()))
def test_query(spark, database, name):
    result = entry.queries()[name](spark, FOLDER)
    cursor = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert sorted_rows(result.columns, result.collect()) == sorted_rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_path_listing(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_first_of_several_journeys_is_the_best(spark):
    best = {r.query_id: r.cost for r in entry.queries()["best_journey"](spark, FOLDER).collect()}
    several = entry.queries()["k_journeys"](spark, FOLDER).collect()
    assert {r.query_id: r.cost for r in several if r.journey_rank == 1} == best
    assert all(r.journey_rank <= 1 + r.query_id % 3 for r in several)


def test_entry(spark):
    assert entry.entry(spark).count() > 0

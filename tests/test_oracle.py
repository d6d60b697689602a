"""Every query gives the rows its SQL gives, on the ordinary ways and on those for large data."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from fleetloom.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Queries in which keys, lookups or positions have a way of their own for large data.
LARGE_WAYS = [
    "align_top_up",
    "zip_positional",
    "align_by_user",
    "zip_unaligned",
    "shuffle_right_half",
    "shuffle_rows",
    "purge_listed",
    "purge_from_date",
    "concat_numbered_lines",
    "flagship",
]


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _cell(value):
    return round(value, 6) if isinstance(value, float) else value


def _check(spark, oracle, name):
    frame = entry.queries()[name](spark, SF_DIR)
    result = oracle.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(names)
    expected = sorted((tuple(map(_cell, row)) for row in result.fetchall()), key=str)
    got = sorted((tuple(_cell(row[c]) for c in names) for row in frame.collect()), key=str)
    assert got == expected
    assert got


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    _check(spark, oracle, name)


@pytest.mark.parametrize("name", LARGE_WAYS)
def test_large_ways_equal_sql(spark, oracle, name, small_limits):
    _check(spark, oracle, name)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

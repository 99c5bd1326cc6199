"""Every registered query equals its SQL equivalent in DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracles

SF = "/root/testdata/sf0.001"
NAMES = [name for area in (entry.prepare, entry.measure, entry.score) for name in area.QUERIES]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in check_oracles.TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, note = check_oracles.compare(spark, con, SF, name)
    assert ok, note


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

"""Every query of the package runs on the smallest tables, and equals its SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracles
from tallyboard.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in check_oracles.TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 1 + len(queries.QUERIES)))
    assert set(queries.QUERIES) <= set(entry.queries())
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equals_sql(spark, con, name):
    ok, note = check_oracles.compare(spark, con, SF, name)
    assert ok, note


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES and n != "op4_warc_archive"])
def test_covers_all_documents(spark, docs, name):
    ids = {r.doc_id for r in entry.queries()[name](spark, SF).select("doc_id").collect()}
    every = {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids <= every if name == "op5_secret_scan" else ids == every

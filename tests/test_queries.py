"""Every registered query against its SQL, on the small tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tallyfolio.catalog.oracles import all_oracles
from tallyfolio.catalog.fixtures import TABLES
from tallyfolio.catalog.queries import all_queries
from tools.check_queries import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "client_account_id", "value", "return", "dividends"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, result.fetchall(), columns) is None

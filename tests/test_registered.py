"""Every registered query against its SQL, over the smallest whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare
from testbed import oracle
from testbed.oracle import ORACLE
from testbed.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_the_sql_is_not_the_engines():
    with open(oracle.__file__, encoding="utf-8") as source:
        assert "candlestream" not in source.read()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, db, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert compare(got, db.sql(contract.oracle_sql()[name]).df()) == ""
    assert len(got)

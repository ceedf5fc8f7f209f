"""Every registered query against its SQL twin, over the smallest test tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, twin, name):
    frame = contract.queries()[name](spark, DATA)
    rows = frame.collect()
    assert rows, "a query returns rows"
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        result = twin.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(frame.columns)
        assert table_of(frame.columns, rows) == table_of(names, result.fetchall())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

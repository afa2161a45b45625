"""Every registered query against its SQL on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracle import oracles
from checks.queries import registered

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
        yield connection


def test_every_query_has_its_sql():
    assert registered().keys() == oracles().keys()
    assert contract.queries().keys() >= registered().keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= oracles().keys()


@pytest.mark.parametrize("query", sorted(registered()))
def test_query_matches_its_sql(spark, database, query):
    df = contract.queries()[query](spark, DATA)
    columns = sorted(df.columns)
    relation = database.execute(contract.oracle_sql()[query])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=repr)
    found = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    assert found == wanted


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "cell_key" and df.count() > 0

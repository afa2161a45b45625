"""Keyed writes of tables that already have the numbers given to added orders."""

import duckdb
import pytest

from checks.oracle import oracles
from checks.queries import registered


@pytest.fixture(scope="module")
def orders(tmp_path_factory):
    """A folder with orders whose keys cross the millionth."""
    folder = tmp_path_factory.mktemp("large")
    keys = "SELECT * FROM (SELECT unnest(range(30)) AS k UNION ALL SELECT unnest(range(999990, 1000030)))"
    with duckdb.connect() as connection:
        connection.execute(
            f"""
            COPY (SELECT k AS o_orderkey, k % 37 AS o_custkey, ['F', 'O', 'P'][k % 3 + 1] AS o_orderstatus,
                    k + 0.25::DOUBLE AS o_totalprice, TIMESTAMP '1996-01-01' + to_days(k::INTEGER % 900) AS o_orderdate,
                    ['1-URGENT', '5-LOW'][k % 2 + 1] AS o_orderpriority
                FROM ({keys}))
            TO '{folder}/orders.parquet' (FORMAT parquet)
            """
        )
    return str(folder)


@pytest.mark.parametrize("query", ["q_load_flat", "q_upsert", "q_upsert_files"])
def test_added_orders_whose_numbers_are_taken(spark, orders, query):
    df = registered()[query](spark, orders)
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW orders AS SELECT * FROM '{orders}/orders.parquet'")
        relation = connection.execute(oracles()[query])
        names = [d[0] for d in relation.description]
        wanted = sorted(relation.fetchall(), key=repr)
    assert df.columns == names
    found = sorted((tuple(row) for row in df.collect()), key=repr)
    assert len(found) == 80 and found == wanted

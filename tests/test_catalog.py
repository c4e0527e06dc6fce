"""Every query with SQL gives the rows of DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows_of
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 80


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_rows(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())

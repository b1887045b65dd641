"""Every registered query against its oracle in DuckDB, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def in_order(names, rows):
    places = sorted(range(len(names)), key=lambda place: names[place])
    return sorted(tuple(repr(row[place]) for place in places) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, SF)
    expected = oracle.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert in_order(df.columns, df.collect()) == in_order(expected.columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0

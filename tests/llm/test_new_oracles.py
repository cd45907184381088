"""Operators with SQL against it, on the small tables."""

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_fim", "op13_negatives"])
def test_query_equals_its_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    places = [expected.columns.index(c) for c in df.columns]
    got = sorted(repr(tuple(r)) for r in df.collect())
    assert got and got == sorted(repr(tuple(r[i] for i in places)) for r in expected.fetchall())

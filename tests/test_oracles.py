"""Every registered query against its oracle, and the coverage of the survey."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as driver
from tierline.suite import ENTRIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    return float(value) if isinstance(value, decimal.Decimal) else value


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_equals_oracle(spark, oracle, name):
    df = driver.queries()[name](spark, SF_DIR)
    expected = oracle.sql(driver.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    spark_types, sql_types = dict(df.dtypes), dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[spark_types[c]] for c in columns} == {c: sql_types[c] for c in columns}

    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    places = [expected.columns.index(c) for c in columns]
    wanted = sorted(repr(tuple(plain(r[i]) for i in places)) for r in expected.fetchall())
    assert got == wanted
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "CollectLimit"):
        assert operator not in plan
    assert got, "an empty result proves nothing"


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_operator_is_covered():
    groups = {"SRC": 13, "INC": 10, "PRJ": 21, "DER": 28, "JOIN": 5, "SET": 1, "AGG": 12, "RSH": 1, "TOP": 4, "SNK": 14, "DQ": 4, "STR": 2}
    wanted = {f"{group}{n}" for group, count in groups.items() for n in range(1, count + 1)}
    covered = {operator for entry in ENTRIES.values() for operator in entry.covers}
    assert wanted - covered == set()
    assert covered - wanted == set()

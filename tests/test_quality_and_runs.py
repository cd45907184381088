"""Checks, audit questions."""

import pytest
from pyspark.sql import functions as F

from tierline.operators import quality, runs


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, `odd name` string")


def test_checks(orders, rows):
    results = quality.run_checks(
        orders,
        [
            {"type": "row_count_min", "threshold": 3},
            {"type": "null_check", "columns": ["id", "odd name"]},
            {"type": "custom_sql", "query": "SELECT max(id) FROM {table}", "expected": 3},
            {"type": "custom_sql", "query": "SELECT id FROM {table} WHERE id > 9"},
            {"type": "custom_sql", "query": "SELECT CAST(NULL AS INT) FROM {table}"},
            {"type": "nonsense"},
        ],
    )
    assert results.columns == list(quality.RESULT_COLUMNS)
    assert [r.passed for r in results.collect()] == [True, True, False, True, True, True, False]
    with pytest.raises(quality.QualityError) as failure:
        quality.require(results)
    assert [(r["type"], r["item"], r["actual"]) for r in failure.value.rows] == [
        ("null_check", "odd name", 1), ("nonsense", None, None),
    ]


def test_verdicts(orders, spark):
    assert quality.require(quality.run_checks(orders, [])) == "skipped"
    assert quality.require(quality.run_checks(orders, [{"type": "row_count_min"}])) == "passed"
    with pytest.raises(quality.QualityError):
        quality.require(quality.row_count_min(orders.limit(0)))


def test_latest_and_recent_runs(spark, rows):
    audit = spark.createDataFrame([("a", n, n % 7) for n in range(30)] + [("b", 1, 1)], "pipeline_name string, run int, at int")
    order = [F.col("at").desc(), F.col("run").desc()]
    assert rows(runs.latest_run(audit, "pipeline_name", order)) == [("a", 27, 6), ("b", 1, 1)]
    recent = runs.recent_runs(audit, "pipeline_name", order, 10)
    assert recent.filter("pipeline_name = 'a'").count() == 10
    assert rows(recent.filter("recency = 1"), "run") == [(1,), (27,)]


def test_status_of_pipelines_without_runs(spark, rows):
    known = spark.createDataFrame([("a",), ("never",)], "pipeline_name string")
    audit = spark.createDataFrame([("a", 1), ("a", 2)], "pipeline_name string, at int")
    control = spark.createDataFrame([("a", "w")], "pipeline_name string, last_watermark_value string")
    assert rows(runs.run_status(known, audit, control, [F.col("at").desc()])) == [("a", 2, "w"), ("never", None, None)]


def test_newest_version(spark, rows):
    df = spark.createDataFrame([("t", 1, "x"), ("t", 3, "y"), ("u", 2, "z")], "name string, at int, schema string")
    assert rows(runs.newest_version(df, "name", "at", ["schema"])) == [("t", "y"), ("u", "z")]


def test_a_check_whose_result_is_no_whole_number_fails(spark):
    from tierline.operators import quality

    df = spark.range(3)
    told = lambda q, e=0: tuple(quality.custom_sql(df, q, e).select("actual", "passed").first())
    assert told("SELECT 0.5 FROM {table}") == (None, False)
    assert told("SELECT 'bad' FROM {table}") == (None, False)
    assert told("SELECT avg(id) FROM {table}", 1) == (1, True)
    assert told("SELECT 9000000000 FROM {table}", 9_000_000_000) == (9_000_000_000, True)
    assert told("SELECT id FROM {table} WHERE false") == (0, True)

"""Watermarks, bounds, windows, period lists, strategies."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tierline.operators import incremental as inc


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [("202401", "2024-01-05T00:00:00"), ("202402", "2024-02-05T00:00:00"), ("202403", None), (None, "2024-03-05T00:00:00")],
        "period string, lastUpdated string",
    )


@pytest.fixture
def control(spark):
    return spark.createDataFrame([("a", "5", "mon", "r1"), ("b", "7", "mon", "r2")], inc.WATERMARK_SCHEMA)


def test_bounds(facts):
    assert inc.after(facts, "lastUpdated", "2024-02-05T00:00:00").count() == 1
    assert inc.after(facts, "LASTUPDATED", "2024-02-05T00:00:00", inclusive=True).count() == 2
    assert inc.after(facts, "lastUpdated", None) is facts


def test_watermark_table(spark, rows, control):
    assert tuple(inc.read_watermark(control, "a").first()) == ("5", "mon", "r1")
    assert tuple(inc.read_watermark(control, "new").first()) == (None, None, None)
    assert tuple(inc.boundaries(inc.read_watermark(control, "new"), "k").first()) == ("k", None)
    updates = spark.createDataFrame([("a", "9", "tue", "r3"), ("b", "", "tue", "r3"), ("c", None, "tue", "r3"), ("d", "1", "tue", "r3")], inc.WATERMARK_SCHEMA)
    after = inc.write_watermark(control, updates)
    assert rows(after) == [("a", "9", "tue", "r3"), ("b", "7", "mon", "r2"), ("d", "1", "tue", "r3")]
    assert rows(inc.write_watermark(after, updates)) == rows(after)


def test_largest_values(spark):
    df = spark.createDataFrame([("9", 1), ("10", 2), ("", 3), (None, 4)], "t string, n int")
    assert inc.batch_watermark(df, "t").first()[0] == "9"
    assert inc.batch_watermark(df.filter("n > 2"), "t").first()[0] is None
    assert inc.table_watermark(df, "n").first()[0] == 4
    assert inc.table_watermark(df, "n", mode="full").first()[0] is None
    assert inc.table_watermark(df, "n", mode="rolling_window").first()[0] is None


def test_windows_and_lists(facts, rows):
    period = F.col("period")
    assert rows(inc.rolling_months(facts, period, date(2024, 3, 31), 2), "period") == [("202402",), ("202403",)]
    assert inc.parse_periods(" 202401, ,202402,") == ["202401", "202402"]
    assert inc.parse_periods(["202401", ""]) == ["202401", ""]
    assert rows(inc.in_periods(facts, period, "202401"), "period") == [("202401",)]


def test_choice_of_strategy():
    assert inc.strategy_of() == "full"
    assert inc.strategy_of(mode="incremental") == "incremental"
    assert inc.strategy_of("rolling_window", "incremental") == "rolling_window"
    assert inc.strategy_of("rolling_window", "incremental", "full") == "full"


def test_reads(facts, rows):
    common = {"key": "lastUpdated", "bound": "2024-01-05T00:00:00", "period": F.col("period"), "as_of": date(2024, 2, 10), "months": 1}

    def periods(strategy, **extra):
        return [p for (p,) in rows(inc.read_incremental(facts, strategy, **common, **extra), "period")]

    assert len(periods("full")) == 4
    assert periods("full", default_periods="202401") == ["202401"]
    assert periods("incremental", default_periods="202401") == ["202402", None]
    assert periods("incremental", periods="202402") == ["202402"]
    assert periods("rolling_window", default_periods="202401") == ["202402"]
    assert periods("rolling_window", periods=["202401"]) == ["202401"]
    assert len(inc.read_incremental(facts, "incremental", key="lastUpdated", bound=None).collect()) == 4


def test_empty_batches_stop(spark, facts):
    assert inc.run_unless_empty(facts, lambda df: df.count()) == 4
    assert inc.run_unless_empty(facts.limit(0), lambda df: 1 / 0) is None

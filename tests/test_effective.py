"""Rules in force, against testing every fact with every rule."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tierline.operators import effective

RULES = "key string, valid_from date, valid_to date, name string"
FACTS = "id int, key string, day date"


def brute(facts, rules):
    out = []
    for i, key, day in facts:
        names = [n for k, a, b, n in rules if k is not None and k == key and day is not None and (a is None or a <= day) and (b is None or day < b)]
        assert len(names) <= 1
        out.append((i, names[0] if names else None))
    return sorted(out)


def run(spark, facts, rules, **options):
    done = effective.in_force(spark.createDataFrame(facts, FACTS), spark.createDataFrame(rules, RULES), "key", F.col("day"), {"told": "name"}, **options)
    assert done.columns == ["id", "key", "day", "told"]
    return done


@pytest.mark.parametrize("period", [1, 7, 366, 100_000])
def test_equals_testing_all(spark, period):
    rng = random.Random(period)
    start = date(1969, 12, 1)
    rules, facts = [], [(0, None, start), (1, "a", None), (2, "none", start)]
    for key in "abcdef":
        at = None if rng.random() < 0.5 else start + timedelta(rng.randint(0, 40))
        for k in range(8):
            end = (at or start) + timedelta(rng.randint(1, 90))
            rules.append((key, at, end, f"{key}{k}"))
            at = end + timedelta(rng.choice([0, 0, 5]))
        if rng.random() < 0.5:
            rules.append((key, at, None, f"{key}-open"))
    rules += [(None, start, None, "nobody"), (None, None, None, "nobody")]
    facts += [(i, rng.choice("abcdefg"), start + timedelta(rng.randint(-20, 800))) for i in range(3, 400)]
    done = run(spark, facts, rules, period_days=period)
    assert sorted((r.id, r.told) for r in done.collect()) == brute(facts, rules)


def test_first_and_last_days(spark):
    rules = [("a", date(2024, 1, 10), date(2024, 1, 12), "x"), ("a", date(2024, 1, 12), None, "y")]
    facts = [(d, "a", date(2024, 1, d)) for d in (9, 10, 11, 12, 13)]
    assert [r.told for r in run(spark, facts, rules).sort("id").collect()] == [None, "x", "x", "y", "y"]


@pytest.mark.parametrize(
    "rules",
    [
        [("a", date(2024, 1, 1), date(2024, 2, 2), "x"), ("a", date(2024, 2, 1), None, "y")],
        [("a", date(2024, 1, 1), None, "x"), ("a", date(2024, 2, 1), None, "y")],
        [("a", None, date(2024, 2, 2), "x"), ("a", None, date(2024, 1, 2), "y")],
        [("a", date(2024, 1, 1), date(2024, 9, 1), "x"), ("a", date(2024, 2, 1), date(2024, 3, 1), "y"), ("a", date(2024, 4, 1), date(2024, 5, 1), "z")],
        [("a", date(2024, 1, 1), date(2024, 1, 1), "x")],
        [("a", date(2024, 1, 2), date(2024, 1, 1), "x")],
    ],
)
def test_overlaps_are_an_error(spark, rules):
    with pytest.raises(Exception, match="overlap|ends before"):
        run(spark, [(1, "a", date(2024, 2, 1))], rules).collect()


def test_no_facts_and_no_rules(spark):
    assert run(spark, [], [("a", None, None, "x")]).collect() == []
    assert [r.told for r in run(spark, [(1, "a", date(2024, 2, 1))], []).collect()] == [None]


def test_null_counties_and_open_ends_of_the_survey(spark):
    rows = [("13", "2024-05-05"), ("4", "2025-12-31"), ("4", "2026-01-01"), ("4.0", "2020-01-01"), (None, "2024-05-05"), ("x", "2024-05-05"), ("2", None), ("15", "1999-01-01")]
    df = spark.createDataFrame(rows, "basic_info_county string, basic_info_date string").withColumn("manual_date", F.col("basic_info_date").cast("timestamp"))
    told = effective.by_survey_rules(df, effective.survey_rules(spark)).select("basic_info_county", "basic_info_date", "managed_county", "ip")
    assert set(map(tuple, told.collect())) == {
        ("13", "2024-05-05", 1, "LMH"),
        ("4", "2025-12-31", 1, "LMH"),
        ("4", "2026-01-01", 0, None),
        ("4.0", "2020-01-01", 1, "LMH"),
        (None, "2024-05-05", 0, None),
        ("x", "2024-05-05", 0, None),
        ("2", None, 0, None),
        ("15", "1999-01-01", 0, "Plan"),
    }


def test_plan_has_no_nested_loop_and_splits_a_hot_key(spark):
    facts = spark.range(200_000).select(F.lit(1).alias("key"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("day"), F.col("id"))
    rules = spark.range(5000).select((F.col("id") % 50).alias("key"), F.date_add(F.lit("2019-01-01").cast("date"), (F.col("id") - F.col("id") % 50).cast("int")).alias("valid_from"))
    rules = rules.withColumn("valid_to", F.date_add("valid_from", 50)).withColumn("name", F.lit("x"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")if spark.conf.get(k, None)}
    for value in (-1, 10_000_000):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
        done = effective.in_force(facts, rules, "key", F.col("day"), {"told": "name"})
        assert done.count() == 200_000
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    for k, v in kept.items():
        spark.conf.set(k, v)

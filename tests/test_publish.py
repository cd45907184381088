"""Reports on odd groups, long rows, target lookup, upsert, publishing."""

from pyspark.sql import functions as F

from tierline.operators import joins, reports
from tierline.plans.publish import publish_monthly
from tierline.sinks import publish
from tierline.sinks.tables import SnapshotTable

UPDATES = (
    "id string, numerator long, denominatorOverride long, value double, narrative string, status string, "
    "risks array<string>, mitigations array<string>, month int, year int, okrId string, "
    "createdByEmail string, updatedByEmail string, createdAt string, updatedAt string"
)


def test_measures_of_groups_without_answers(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 0), ("b", None)], "g string, f int")
    got = df.groupBy("g").agg(
        reports.group_size("n"),
        reports.flag_sum(F.col("f"), "s"),
        reports.flag_hits(F.col("f"), "h"),
        reports.answered(F.col("f"), "d"),
        reports.flag_percentage(F.col("f"), "p"),
    )
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2, None, 0, 0, None), ("b", 3, 1, 1, 2, 50.0)]


def test_long_rows(spark, rows):
    wide = spark.createDataFrame([(2024, 1, 5, 10), (2024, 2, None, 20)], "cy_year int, cy_month int, hits int, total int")
    got = reports.indicator_rows(wide, {"1": ("hits", "total"), "2": ("absent", "total")}, ["cy_year", "cy_month", "region"])
    assert got.columns == ["cy_year", "cy_month", "region", "indicator_id", "numerator", "denominator"]
    assert rows(got, "cy_month", "region", "indicator_id", "numerator", "denominator") == sorted(
        [(1, None, "1", 5, 10), (1, None, "2", None, 10), (2, None, "1", None, 20), (2, None, "2", None, 20)], key=repr
    )


def _indicator_rows(spark):
    return spark.createDataFrame(
        [
            ("2.2", 2024, 1, 1, 30, 40), ("2.2", 2024, 1, 0, 1, 2), ("2.2", 2024, 2, None, 1, 2), ("2.3", 2024, 1, 1, 5, 0),
            ("9.9", 2024, 1, 1, 1, 2), ("2.4", 2024, 3, 1, None, 7),
        ],
        "indicator_id string, cy_year int, cy_month int, managed_county int, numerator long, denominator long",
    )


def _targets(spark):
    return spark.createDataFrame(
        [("def-b", "2.2", 10.0), ("def-a", "2.2", 100.0), ("def-c", "2.3", 50.0), ("def-d", "2.4", None)],
        "id string, okrId string, targetValue double",
    )


def test_lookup_takes_the_first_target(spark, rows):
    found, skipped = publish.monthly_values(_indicator_rows(spark), _targets(spark))
    assert rows(found, "target_id", "value", "status") == sorted(
        [("def-a", 75.0, "on_track"), ("def-c", None, "on_track"), ("def-d", None, "on_track")], key=repr
    )
    assert rows(skipped, "indicator_id") == [("9.9",)]
    assert rows(publish.publish_counts(_indicator_rows(spark), _targets(spark))) == [(3, 3)]


def test_upsert_keeps_what_users_entered(spark, rows):
    existing = spark.createDataFrame(
        [
            ("u1", 1, 2, 50.0, "mine", "delayed", ["r"], ["m"], 1, 2024, "def-a", "u@x", "u@x", "t0", "t0"),
            ("u2", 1, 2, 50.0, "other", "delayed", None, [], 5, 2023, "def-a", "u@x", "u@x", "t0", "t0"),
            ("u3", 7, 8, 87.5, "empty now", "achieved", [], [], 3, 2024, "def-d", "u@x", "u@x", "t0", "t0"),
        ],
        UPDATES,
    )
    found, _ = publish.monthly_values(_indicator_rows(spark), _targets(spark))
    batch = publish.monthly_batch(found, "bot@x", F.lit("t1"))
    got = publish.upsert_monthly(existing, batch)
    assert got.columns == existing.columns
    by_key = {(r.okrId, r.year, r.month): r for r in got.collect()}
    assert set(by_key) == {("def-a", 2024, 1), ("def-a", 2023, 5), ("def-d", 2024, 3), ("def-c", 2024, 1)}

    updated = by_key["def-a", 2024, 1]
    assert (updated.id, updated.numerator, updated.value, updated.status) == ("u1", 30, 75.0, "on_track")
    assert (updated.narrative, updated.risks, updated.createdAt, updated.updatedAt) == ("mine", ["r"], "t0", "t1")
    assert (updated.createdByEmail, updated.updatedByEmail) == ("u@x", "bot@x")

    emptied = by_key["def-d", 2024, 3]
    assert (emptied.numerator, emptied.denominatorOverride, emptied.value, emptied.narrative) == (None, 7, None, "empty now")

    untouched = by_key["def-a", 2023, 5]
    assert untouched == existing.filter("id = 'u2'").first()

    fresh = by_key["def-c", 2024, 1]
    assert (fresh.narrative, fresh.risks, fresh.mitigations, fresh.createdByEmail) == ("", [], [], "bot@x")
    assert len(fresh.id) == 64

    again = publish.upsert_monthly(got, batch)
    assert rows(again) == rows(got)


def test_one_row_per_key_reaches_the_upsert(spark, rows):
    values = spark.createDataFrame(
        [("d", 2024, 1, 1, 2, 50.0, "s", 1), ("d", 2024, 1, 9, 10, 90.0, "s", 2)],
        "target_id string, cy_year int, cy_month int, numerator long, denominator long, value double, status string, seq int",
    )
    assert rows(publish.monthly_batch(values, "x", F.lit("t"), last=F.col("seq")), "numerator") == [(9,)]


def test_publishing_as_text(spark, rows, tmp_path):
    df = spark.sql("SELECT 1 AS n, 1.5D AS d, CAST(NULL AS INT) AS e, array(1) AS a, true AS b")
    path = str(tmp_path / "out")
    assert publish.publish_files(df.limit(0), path) == "skipped" and not (tmp_path / "out").exists()
    assert publish.publish_files(df, path) == "loaded"
    assert publish.publish_files(df, path, "append") == "loaded"
    got = spark.read.parquet(path)
    assert {t for _, t in got.dtypes} == {"string"}
    assert rows(got) == [("1", "1.5", None, "[1]", "true")] * 2
    publish.publish_files(df, path, "replace")
    assert spark.read.parquet(path).count() == 1


def test_star(spark, rows):
    fact = spark.createDataFrame([("e1", "o1", 1), ("e2", "o9", 2), (None, "o1", 3)], "element string, unit string, v int")
    elements = spark.createDataFrame([("e1", "E one"), ("e1", "E uno"), (None, "nobody")], "id string, name string")
    units = spark.createDataFrame([("o1", "U")], "id string, name string")
    got = joins.star_join(
        fact,
        [joins.Dimension(elements, "element", "id", {"element_name": "name"}), joins.Dimension(units, "unit", "id", {"unit_name": "name"})],
    )
    assert rows(got) == sorted(
        [("e1", "o1", 1, "E one", "U"), ("e1", "o1", 1, "E uno", "U"), ("e2", "o9", 2, None, None), (None, "o1", 3, None, "U")], key=repr
    )


def test_publish_job(spark, rows, tmp_path):
    report = spark.createDataFrame(
        [(2024, 1, 1, 40, 30, None, 8, 5, 10), (2024, 1, 0, 9, 1, 1, 1, 1, 1)],
        "cy_year int, cy_month int, managed_county int, total_surveyed long, n_correct_ontime_fy26 long, n_has_chc long, "
        "n_lifesaving_instock long, n_two_plusvisits long, d_two_plusvisits long",
    )
    updates = SnapshotTable(spark, str(tmp_path / "updates"))
    updates.replace(spark.createDataFrame([], UPDATES))
    for _ in range(2):
        assert tuple(publish_monthly(report, _targets(spark), updates, "bot@x", F.lit("t"))) == (3, 5)
    assert rows(updates.read(), "okrId", "numerator", "value") == [("def-a", 30, 75.0), ("def-c", None, None), ("def-d", 8, 20.0)]
    assert publish_monthly(report.limit(0), _targets(spark), updates, "bot@x", F.lit("t")) is None


def test_upsert_of_null_and_repeated_keys(spark, rows):
    existing = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "n"), ("b", 4, "z")], "k string, v int, kept string")
    incoming = spark.createDataFrame([("a", 10), (None, 11), ("c", None)], "k string, v int")
    got = joins.upsert(existing, incoming, ["k"], ["v"], {"kept": F.concat(F.lit("seed "), F.coalesce("new.k", F.lit("?")))})
    assert got.schema.simpleString() == existing.schema.simpleString()
    assert rows(got) == sorted(
        [("a", 10, "x"), ("a", 10, "y"), (None, 3, "n"), ("b", 4, "z"), (None, 11, "seed ?"), ("c", None, "seed c")], key=repr
    )

"""Reports from changes against reports of whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from tierline.operators import maintained, reports
from tierline.sinks.tables import ConcurrentCommit, SnapshotTable

FLAGS = sorted({*reports.ALWAYS_SET.values(), *(s for s, _ in reports.MAYBE_UNANSWERED.values())})
SCHEMA = ", ".join(
    ["_id long", "cy_year int", "cy_month int", "fy_year int", "fy_quarter int", "county_label string", "managed_county int",
     "health_services_communityengagement_chc string", *[f"{c} int" for c in FLAGS]]
)


def surveys(spark, ids, seed, months=6):
    rng = random.Random(seed)
    rows = []
    for i in ids:
        month = i % months + 1
        flags = [rng.choice([0, 1, None]) for _ in FLAGS]
        rows.append((i, 2024, month, rng.choice([2024, None]), month // 4, rng.choice(["A", "B", None]), rng.randint(0, 1), rng.choice(["1", "0", "x", None]), *flags))
    return spark.createDataFrame(rows, SCHEMA)


def same(got, want):
    assert got.schema == want.select(*got.columns).schema or [f.dataType for f in got.schema] == [f.dataType for f in want.select(*got.columns).schema]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


KEYS = ["cy_year", "cy_month", "_id"]


@pytest.mark.parametrize("layout", [{"partition_by": ["cy_year", "cy_month"]}, {"bucket_by": ["_id"], "buckets": 5}, {}])
def test_equal_to_the_full_report_after_each_load(spark, tmp_path, layout):
    base = SnapshotTable(spark, str(tmp_path / "base"), **layout)
    quarter = maintained.MaintainedReport(base, str(tmp_path / "q"), maintained.fiscal_quarter())
    month = maintained.MaintainedReport(base, str(tmp_path / "m"), maintained.calendar_month())
    loads = [
        lambda: base.merge(surveys(spark, range(60), 1), KEYS),
        lambda: base.merge(surveys(spark, range(30, 90), 2), KEYS),
        lambda: base.append(surveys(spark, range(200, 210), 3)),
        lambda: base.replace(base.read().filter("_id % 7 <> 0")),
        lambda: base.merge(surveys(spark, [5], 4), KEYS),
    ]
    for k, load in enumerate(loads):
        load()
        assert quarter.refresh() == base.version() == quarter.at()
        same(quarter.read(), reports.fiscal_quarter_report(base.read()))
        if k % 2 == 0:  # the other is behind by up to two loads
            month.refresh()
            same(month.read(), reports.calendar_month_report(base.read()))
    assert quarter.refresh() == base.version()
    same(quarter.read(), reports.fiscal_quarter_report(base.read()))


def test_reads_touched_parts_only(spark, tmp_path):
    base = SnapshotTable(spark, str(tmp_path / "base"), partition_by=["cy_year", "cy_month"])
    base.merge(surveys(spark, range(600), 1), KEYS)
    since = base.version()
    base.merge(surveys(spark, [6, 12], 2), KEYS)  # of one month of six
    _, gone, come = base.changes(since)
    assert gone.count() == come.count() == 100
    assert not set(gone.inputFiles()) & set(base.read().inputFiles())
    assert len(come.inputFiles()) < len(base.read().inputFiles())


def test_a_refresh_that_dies_or_comes_late(spark, tmp_path, monkeypatch):
    base = SnapshotTable(spark, str(tmp_path / "base"))
    report = maintained.MaintainedReport(base, str(tmp_path / "q"), maintained.calendar_month())
    base.append(surveys(spark, range(20), 1))
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(SnapshotTable, "_renamed", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        report.refresh()
    assert report.at() == 0 and report.refresh() == 1
    base.append(surveys(spark, range(20, 30), 2))
    stale = maintained.MaintainedReport(base, str(tmp_path / "q"), maintained.calendar_month())
    with monkeypatch.context() as patch:
        patch.setattr(stale.state, "version", lambda: 0)
        with pytest.raises(ConcurrentCommit):
            stale.refresh()
    assert report.refresh() == 2
    same(report.read(), reports.calendar_month_report(base.read()))


def test_columns_that_come_later(spark, tmp_path):
    base = SnapshotTable(spark, str(tmp_path / "base"))
    report = maintained.MaintainedReport(base, str(tmp_path / "q"), maintained.calendar_month())
    base.append(surveys(spark, range(20), 1).drop("two_plusvisits").withColumn("two_plusvisits", F.lit(None).cast("int")))
    report.refresh()
    base.append(surveys(spark, range(20, 40), 2).withColumn("more", F.lit(1)))
    report.refresh()
    same(report.read(), reports.calendar_month_report(base.read()))


def test_nothing_left_of_a_group(spark, tmp_path):
    base = SnapshotTable(spark, str(tmp_path / "base"))
    report = maintained.MaintainedReport(base, str(tmp_path / "q"), maintained.calendar_month())
    base.append(surveys(spark, range(20), 1))
    report.refresh()
    base.replace(base.read().limit(0))
    report.refresh()
    assert report.read().collect() == []

"""Tables distributed by a key: results, and that their rows are not shuffled."""

import pytest
from pyspark.sql import functions as F

from tierline.operators.joins import Dimension, star_join
from tierline.sinks.distributed import DistributedTable
from tierline.sinks.tables import merged


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above(df, mark="Bucketed: true"):
    """For each bucketed scan, the operators between it and the result."""
    stack, found = [], []
    for line in plan(df).splitlines():
        text = line.lstrip(" :+-")
        depth = len(line) - len(text)
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if mark in text:
            found.append([t for _, t in stack])
        stack.append((depth, text))
    return found


@pytest.fixture
def shuffles(spark):
    """No side is small enough to be broadcast."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, n string, v string")


FIRST = [(i, f"n{i % 3}", "old") for i in range(200)] + [(None, "n", "old"), (7, "n1", "twice")]
SECOND = [(i, f"n{i % 3}", "new") for i in range(150, 260)] + [(None, "n", "new"), (7, None, "new")]


@pytest.mark.parametrize("keys", [["k"], ["n", "k"]])
def test_merge_equals_the_plain_one(spark, rows, tmp_path, shuffles, keys):
    table = DistributedTable(spark, str(tmp_path / "t"), keys, 8)
    table.merge(frame(spark, FIRST))
    table.merge(frame(spark, SECOND), keys)
    assert rows(table.read()) == rows(merged(frame(spark, FIRST), frame(spark, SECOND), keys))
    assert len(list((tmp_path / "t" / table._current().folders[0]).glob("*.parquet"))) == 8
    table.append(frame(spark, FIRST[:5]))
    table.merge(frame(spark, [(1, "n1", "last")]).withColumn("more", F.lit(1.5)))
    assert len(table._current().folders) == 1 and table.read().columns == ["k", "n", "v", "more"]
    with pytest.raises(ValueError, match="distribute"):
        table.merge(frame(spark, FIRST), ["v"])


def test_nothing_is_shuffled_above_the_table(spark, tmp_path, shuffles, monkeypatch):
    table = DistributedTable(spark, str(tmp_path / "t"), ["k"], 8)
    table.replace(frame(spark, FIRST))
    table.append(frame(spark, SECOND))
    written = []
    plain = DistributedTable._dealt
    monkeypatch.setattr(DistributedTable, "_dealt", lambda self, df: written.append(plain(self, df)) or written[-1])
    table.merge(frame(spark, SECOND))
    dim = spark.range(300).select(F.col("id").cast("int").alias("id"), F.lit("d").alias("name"))
    wide = star_join(table.read(), [Dimension(dim, "k", "id", {"name": "name"})])
    for df, scans in ((written[-1], 2), (wide, 1), (table.read().groupBy("k").count(), 1)):
        paths = above(df)
        assert len(paths) == scans
        assert not [t for path in paths for t in path if "Exchange" in t], plan(df)
    assert "Exchange" in plan(written[-1]) and "Exchange" in plan(wide)
    assert wide.filter("name = 'd'").count() == table.read().filter("k is not null").count()


def test_two_distributed_sides_meet_without_a_shuffle(spark, rows, tmp_path, shuffles):
    facts = DistributedTable(spark, str(tmp_path / "f"), ["k"], 8, ["v"])
    facts.replace(frame(spark, FIRST))
    units = DistributedTable(spark, str(tmp_path / "u"), ["id"], 8)
    units.replace(spark.range(100).select(F.col("id").cast("int").alias("id"), F.col("id").cast("string").alias("name")))
    wide = star_join(facts.read(), [Dimension(units.read(), "k", "id", {"name": "name"})])
    assert "Exchange" not in plan(wide)
    assert rows(wide, "k", "v", "name") == sorted([(k, v, str(k) if k is not None and k < 100 else None) for k, _, v in FIRST], key=repr)


def test_another_session_reads_the_buckets(spark, rows, tmp_path):
    DistributedTable(spark, str(tmp_path / "it's"), ["K"], 4).replace(frame(spark, FIRST))
    other = DistributedTable(spark.newSession(), str(tmp_path / "it's"), ["k"], 4)
    assert "Bucketed: true" in plan(other.read().groupBy("k").count())
    assert rows(other.read()) == rows(frame(spark, FIRST))

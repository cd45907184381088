"""What Spark makes of the operators: pruning, pushdown, skew, no Python, no cross joins."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierline.operators import incremental, joins, reports, runs, shape
from tierline.sinks import layers
from tierline.sinks.tables import merged
from tierline.suite import inputs, source_queries
from tierline.suite.registry import table

SF_DIR = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    """The plan as adaptive execution left it, after running it here."""
    df.collect()
    return physical(df)


@contextmanager
def settings(spark, **values):
    names = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def shuffled_joins(spark):
    """Joins as they run when no side is small, and partitions of a few KB count as skewed."""
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    ):
        yield


def test_report_reads_three_columns_and_shuffles_partial_sums(spark):
    plan = physical(reports.fiscal_quarter_report(inputs.curated(spark, SF_DIR)))
    (schema,) = re.findall(r"ReadSchema: (\S+)", plan)
    assert set(re.findall(r"(\w+):", schema)) - {"struct"} == {"o_orderkey", "o_custkey", "o_orderdate"}
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan[plan.index("Exchange") :]


def test_record_report_does_not_shuffle(spark):
    assert "Exchange" not in physical(reports.record_report(inputs.curated(spark, SF_DIR)))


def test_long_rows_do_not_shuffle_again(spark):
    report = reports.calendar_month_report(inputs.curated(spark, SF_DIR))
    assert physical(reports.indicator_rows(report)).count("Exchange hashpartitioning") == 1


def test_small_dimensions_are_broadcast_by_their_size(spark):
    plan = physical(source_queries.star_view(spark, SF_DIR))
    assert plan.count("BroadcastHashJoin") == 4
    with settings(spark, autoBroadcastJoinThreshold="100"):
        assert "BroadcastHashJoin" not in physical(source_queries.star_view(spark, SF_DIR))


def _hot_fact(spark, n=60_000):
    """A third of the rows share a key, and a sixth have none."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 6 == 1, None).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("t"))


def test_a_hot_key_is_split_in_a_star_join(spark, shuffled_joins):
    dim = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    joined = joins.star_join(_hot_fact(spark), [joins.Dimension(dim, "k", "key", {"dim_name": "name"})])
    assert "skew=true" in final(joined)
    got = joined.agg(F.count(F.lit(1)), F.count("dim_name"), F.count_if(F.col("k") == 1)).first()
    assert tuple(got) == (60_000, 50_000, 20_000)


def test_a_hot_key_is_split_in_a_merge(spark, shuffled_joins):
    staging = spark.range(30_000, 90_000, 1, 4).select(F.col("id").alias("k"), F.col("id").alias("v"), F.lit("new").alias("t"))
    result = merged(_hot_fact(spark), staging, ["k"])
    assert "skew=true" in final(result)
    kept = result.filter("t <> 'new'")
    assert result.filter("t = 'new'").count() == 60_000
    # all of the hot key, all without a key, and half of the others
    assert (kept.filter("k = 1").count(), kept.filter("k IS NULL").count()) == (20_000, 10_000)
    assert kept.filter("k > 1").count() == 15_000


def test_losers_are_dropped_before_the_shuffle(spark):
    lines = table(spark, SF_DIR, "lineitem")
    for df in (
        shape.dedup(lines, ["l_orderkey"], [F.col("l_shipdate").desc()]),
        runs.recent_runs(lines, "l_suppkey", [F.col("l_shipdate").desc()], 10),
    ):
        plan = physical(df)
        assert "Partial" in plan[plan.index("Exchange") :] and "WindowGroupLimit" in plan[plan.index("Exchange") :]


def test_bounds_reach_the_scan(spark):
    events = table(spark, SF_DIR, "events")
    plan = physical(incremental.after(events, "event_id", 10))
    assert "GreaterThan(event_id,10)" in plan
    orders = table(spark, SF_DIR, "orders")
    assert "In(o_orderstatus" in physical(incremental.in_periods(orders, F.col("o_orderstatus"), "F,O,P"))


def test_runs_are_pruned_by_folder(spark, tmp_path):
    root = str(tmp_path / "layer")
    df = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("execution_id"))
    layers.write_partitioned(df, root, ["execution_id"])
    read = spark.read.parquet(root).filter("execution_id = '1'")
    assert re.search(r"PartitionFilters: \[[^]]*execution_id", physical(read))
    assert read.count() == 10


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path):
    root = tmp_path / "layer"
    df = _hot_fact(spark).select("v", "t", F.when(F.col("v") % 3 == 0, "hot").otherwise((F.col("v") % 7).cast("string")).alias("part"))
    with settings(spark, adaptive__advisoryPartitionSizeInBytes="100KB"):
        layers.write_partitioned(df, str(root), ["part"])
    assert len(list((root / "part=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(root)).count() == 60_000


def test_the_library_stays_within_its_rules():
    package = Path(__file__).parent.parent / "tierline"
    files = {str(p.relative_to(package)): p.read_text() for p in package.rglob("*.py") if "llm" not in p.parts}
    text = "\n".join(files.values())
    for forbidden in ("localCheckpoint", "crossJoin", ".rdd", "pandas_udf", "@udf", "toPandas", "collect_list", "collect_set"):
        assert forbidden not in text, forbidden
    # The states of byte ranges, up to a number that is counted first; beyond it they are joined by a shuffle.
    assert [name for name, code in files.items() if "broadcast(" in code] == ["sources/arrays.py"]
    assert files["sources/arrays.py"].count("broadcast(") == 1


def test_upsert_splits_a_hot_key(spark, shuffled_joins):
    old = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    new = spark.range(0, 60_000, 2).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    result = joins.upsert(old, new, ["k"], ["v"], {})
    assert "skew=true" in final(result) and "FullOuter" not in final(result)


def test_upsert_sorts_no_row_of_a_hot_key(spark, shuffled_joins):
    old = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    new = spark.range(0, 6_000, 2).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    query = joins.upsert(old, new, ["k"], ["v"], {})._jdf.queryExecution()
    assert re.search(r"Join LeftSemi[^\n]*\n[ :|]*:- Aggregate", query.optimizedPlan().toString())
    plan = query.executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "LeftOuter" not in "".join(line for line in plan.split("\n") if "SortMergeJoin" in line)

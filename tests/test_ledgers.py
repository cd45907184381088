"""Schema ledger, watermark log, footers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import incremental
from tierline.plans import batch
from tierline.sinks import ledger
from tierline.sinks.control import ControlLog, latest
from tierline.sources import files, footers

RUNS = [
    ("r1", "2024-01-01", "a int, B string, n struct<x:int>"),
    ("r3", "2024-01-03", "a int, d array<struct<p:int>>, n struct<y:string,x:int>, e decimal(5,2)"),
    ("r2", "2024-01-02", "b string, c double, e decimal(9,2), m map<string,struct<q:int>>"),
    ("r4", "2024-01-04", "d array<struct<r:string>>, m map<string,struct<q:int,s:int>>"),
]


def test_union_equals_the_merged_footers(spark, tmp_path):
    told, root = str(tmp_path / "ledger"), tmp_path / "runs"
    assert ledger.union_schema(ledger.entries(spark, told)) == T.StructType()
    for run, day, schema in RUNS:
        df = spark.createDataFrame([], schema)
        df.coalesce(1).write.parquet(str(root / day / run))
        ledger.record(spark, told, run, day, df.schema)
    ledger.record(spark, told, "r1", "2024-01-01", spark.createDataFrame([], RUNS[0][2]).schema)
    union = ledger.union_schema(ledger.entries(spark, told))
    assert union.simpleString() == (
        "struct<a:int,B:string,n:struct<x:int,y:string>,c:double,e:decimal(9,2),m:map<string,struct<q:int,s:int>>,d:array<struct<p:int,r:string>>>"
    )
    merged = files.read_all_runs(spark, str(root)).schema

    def plain(dtype):
        text = dtype.simpleString() if not isinstance(dtype, T.StructType) else None
        return text or sorted((f.name.lower(), str(plain(f.dataType))) for f in dtype)

    assert plain(union["a"].dataType) == plain(merged["a"].dataType)
    assert {f.name.lower() for f in union} == {f.name.lower() for f in merged}
    assert files.read_all_runs(spark, str(root), union).schema == union


@pytest.mark.parametrize("other", ["a string", "A long", "a array<int>", "a struct<b:int>"])
def test_conflicts_name_their_runs(spark, tmp_path, other):
    told = str(tmp_path / "ledger")
    for run, schema in (("first", "a int"), ("second", "b int"), ("third", other), ("fourth", other)):
        ledger.record(spark, told, run, f"at {len(run)} {run}", spark.createDataFrame([], schema).schema)
    with pytest.raises(ledger.SchemaConflict, match="column a|column A") as failed:
        ledger.union_schema(ledger.entries(spark, told))
    assert "first" in str(failed.value) and "third" in str(failed.value)


def test_layers_record_their_columns(spark, tmp_path):
    told = str(tmp_path / "ledger")
    for k in (1, 2):
        run = batch.Run("p", f"run-{k}", f"2024-06-1{k}T10:30:00", country="c")
        df = spark.range(3).withColumn(f"c{k}", F.lit("x"))
        batch.write_layer(df, str(tmp_path / "layer"), run, str(tmp_path / "audit"), "processed", ledger_path=told)
    union = ledger.union_schema(ledger.entries(spark, told))
    assert union.simpleString() == "struct<id:bigint,c1:string,c2:string>"
    assert files.read_all_runs(spark, str(tmp_path / "layer"), union).count() == 6


def test_interleaved_writers_lose_nothing(spark, tmp_path):
    one, two = (ControlLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert one.state().collect() == [] and one.watermark("a").first().last_value is None
    before_one, before_two = one.state().collect(), two.state().collect()  # both look, then both write
    two.finish("b", "20", "2024-01-02", "x2")
    one.finish("a", "10", "2024-01-01", "x1")
    assert before_one == before_two == []
    assert {(r.pipeline_name, r.last_watermark_value) for r in one.state().collect()} == {("a", "10"), ("b", "20")}
    one.finish("a", "30", "2024-01-03", "x3")
    two.finish("a", "25", "2024-01-02", "late")  # an earlier run that ends later
    two.finish("b", "", "2024-01-09", "empty")
    two.finish("b", None, "2024-01-09", "none")
    one.finish("a", "30", "2024-01-03", "x3")
    assert tuple(two.watermark("a").first()) == ("30", "2024-01-03", "x3")
    assert tuple(one.watermark("b").first()) == ("20", "2024-01-02", "x2")
    assert sorted(map(tuple, one.state().collect())) == [("a", "30", "2024-01-03", "x3"), ("b", "20", "2024-01-02", "x2")]


def test_log_gives_the_state_of_the_control_table(spark, rows):
    control = spark.createDataFrame([], incremental.WATERMARK_SCHEMA)
    log = []
    for day, updates in enumerate([[("a", "1"), ("b", "1")], [("a", ""), ("c", "7")], [("a", "3")]]):
        batch_ = [(p, v, f"2024-01-0{day}", f"x{day}") for p, v in updates]
        log += batch_
        control = incremental.write_watermark(control, spark.createDataFrame(batch_, incremental.WATERMARK_SCHEMA))
    assert rows(latest(spark.createDataFrame(log, incremental.WATERMARK_SCHEMA))) == rows(control)


def test_bounds_come_from_footers(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("d"), F.col("id").cast("string").alias("s"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    df = df.withColumn("id", F.when(F.col("id") % 5 != 0, F.col("id")))
    df.repartition(3).write.parquet(str(tmp_path / "a"))
    path = str(tmp_path / "a")
    told = footers.extent(spark, path, ["id", "d", "day"])
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan
    want = spark.read.parquet(path).agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.min("d"), F.max("d"), F.min("day"), F.max("day")).first()
    assert tuple(told.first()) == tuple(want)
    texts = footers.extent(spark, path, ["s"])
    assert tuple(texts.first()) == (1000, "0", "999")
    assert footers.table_watermark_of_files(spark, [path], "id").first().max_watermark == 999
    assert footers.table_watermark_of_files(spark, [path], "id", mode="full").first().max_watermark is None
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_files_without_statistics_are_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "a").mkdir()
    pq.write_table(pa.table({"id": pa.array([3, 9, 4])}), tmp_path / "a" / "x.parquet", write_statistics=False)
    assert tuple(footers.extent(spark, str(tmp_path / "a"), ["id"]).first()) == (3, 3, 9)

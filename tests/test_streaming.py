"""File streams: exactly once, and idempotent upserts."""

import pytest
from pyspark.sql import functions as F

from tierline.sinks.tables import SnapshotTable
from tierline.streaming import files as streams


def test_each_file_is_read_once(spark, rows, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        streams.ingest_available(streams.new_files(spark, source, "id long", "csv", header=True), target, checkpoint)

    spark.range(3).coalesce(1).write.csv(source, header=True)
    run()
    run()
    assert rows(spark.read.parquet(target)) == [(0,), (1,), (2,)]
    spark.range(3, 5).coalesce(1).write.mode("append").csv(source, header=True)
    run()
    assert rows(spark.read.parquet(target)) == [(n,) for n in range(5)]


def test_upsert_over_several_batches(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.range(4).withColumn("v", F.lit("old")))
    for n, version in [(2, "one"), (1, "two")]:
        spark.range(n).withColumn("v", F.lit(version)).coalesce(1).write.mode("append").parquet(source)
        streams.upsert_available(
            streams.table_stream(spark, source, files_per_batch=1), table, ["id"], str(tmp_path / "cp"),
            prepare=lambda df: df.withColumn("v", F.upper("v")),
        )
    assert rows(table.read()) == [(0, "TWO"), (1, "ONE"), (2, "old"), (3, "old")]


def test_a_batch_that_comes_again_is_left_out(spark, rows, tmp_path):
    """The commit happened, the acknowledgement did not."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    table = SnapshotTable(spark, str(tmp_path / "t"))
    spark.createDataFrame([(1,), (None,)], "id long").coalesce(1).write.parquet(source)
    table.append(spark.read.parquet(source), tag=f"{checkpoint}#0")
    streams.upsert_available(streams.table_stream(spark, source), table, ["id"], checkpoint)
    assert rows(table.read()) == sorted([(1,), (None,)], key=repr)


def test_partitioned_upsert(spark, rows, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "facts")
    schema = "day string, id long, v string"
    table = SnapshotTable(spark, path, partition_by=["day"])
    table.merge(spark.createDataFrame([("01", 1, "old"), ("02", 1, "old")], schema), ["day", "id"])
    spark.createDataFrame([("02", 1, "new"), ("03", 5, "new")], schema).coalesce(1).write.parquet(source)
    for checkpoint in ("cp", "other-cp"):  # the second one sees the same batch again
        streams.upsert_partitions_available(
            streams.table_stream(spark, source), path, ["day", "id"], ["day"], str(tmp_path / checkpoint)
        )
    assert rows(table.read(), "day", "id", "v") == [("01", 1, "old"), ("02", 1, "new"), ("03", 5, "new")]

    spark.createDataFrame([("02", None, "x")], schema).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="null in the merge key"):
        streams.upsert_partitions_available(
            streams.table_stream(spark, source), path, ["day", "id"], ["day"], str(tmp_path / "cp")
        )


def test_columns_that_files_bring(spark, rows, tmp_path, monkeypatch):
    source, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    source.mkdir()
    table = SnapshotTable(spark, str(tmp_path / "t"))

    def drop(name, *lines):
        (source / name).write_text("\n".join(lines))

    def run():
        streams.ingest_growing(spark, str(source), table, checkpoint)

    drop("a.json", '{"id": 1}', '{"id": 2, "none": null}')
    run()
    assert table.read().columns == ["id"]
    drop("b.json", '{"id": 3, "more": {"x": "y"}, "name": "n"}', '{"name": "m", "id": 4}')
    # The commit happens, its acknowledgement does not.
    plain = SnapshotTable.append

    def dies(self, *args, **options):
        plain(self, *args, **options)
        raise ZeroDivisionError

    with monkeypatch.context() as patch, pytest.raises(Exception, match="ZeroDivisionError"):
        patch.setattr(SnapshotTable, "append", dies)
        run()
    assert table.read().count() == 4
    run()
    drop("c.json", '{"ID": "5", "name": 7}')
    run()
    run()
    assert table.schema().simpleString() == "struct<id:bigint,more:struct<x:string>,name:string>"
    assert rows(table.read().select("id", "more.x", "name")) == sorted([(1, None, None), (2, None, None), (3, "y", "n"), (4, None, "m"), (5, None, "7")], key=repr)
    drop("d.json", '{"id": "five"}')
    with pytest.raises(Exception, match="does not fit bigint"):
        run()
    assert table.read().count() == 5


def test_a_line_that_is_no_record(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": 1}\n{"id": ')
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        streams.ingest_growing(spark, str(tmp_path / "in"), table, str(tmp_path / "cp"))
    assert not table.exists()

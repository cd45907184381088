"""Keyed loads: merge, append, replace, growing schemas, clustered files."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.joins import concat, new_columns
from tierline.plans.load import load
from tierline.sinks import layers, tables
from tierline.sinks.tables import ConcurrentCommit, SnapshotTable, merged, misfits


def test_merge_semantics(spark, rows):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 1, "t"), (None, 1, "t"), ("a", 2, "t")], "k string, n int, v string")
    staging = spark.createDataFrame([("a", 1, "s1"), ("a", 1, "s2"), (None, 1, "s"), ("c", 1, "s")], "k string, n int, v string")
    assert rows(merged(target, staging, ["k", "n"])) == sorted(
        [("b", 1, "t"), ("a", 2, "t"), (None, 1, "t"), (None, 1, "s"), ("a", 1, "s1"), ("a", 1, "s2"), ("c", 1, "s")], key=repr
    )
    with pytest.raises(ValueError):
        merged(target, staging, [])


def test_merge_with_other_columns_and_types(spark, rows):
    target = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "k int, n int, old string")
    staging = spark.createDataFrame([("2", "oops", 1.5), ("3", "30", 2.5)], "K string, n string, extra double")
    with pytest.raises(Exception, match="a value of n does not fit int"):
        merged(target, staging, ["k"]).collect()
    assert rows(misfits(staging, target.schema)) == [("k", 0), ("n", 1)]
    with pytest.raises(Exception, match="a value of K does not fit int"):
        merged(target, staging.withColumn("K", F.lit("x")), ["k"], lossy=True).collect()
    got = merged(target, staging, ["k"], lossy=True)
    assert got.schema.simpleString() == "struct<k:int,n:int,old:string,extra:double>"
    assert rows(got) == [(1, 10, "x", None), (2, None, None, 1.5), (3, 30, None, 2.5)]


def test_table_life(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), sort_keys=["k"])
    assert not table.exists() and table.version() == 0 and table.schema() is None
    with pytest.raises(ValueError):
        table.read()
    table.load(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "merge", ["k"])
    table.load(spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int"), "merge", ["k"])
    assert rows(table.read()) == [(1, "a"), (2, "c"), (3, "d")]
    table.load(spark.createDataFrame([(9, 1.5)], "k int, w double"), "append")
    assert table.read().columns == ["k", "v", "w"]
    assert rows(table.read()) == [(1, "a", None), (2, "c", None), (3, "d", None), (9, None, 1.5)]
    before = table.read()
    table.load(spark.createDataFrame([(5, "z")], "k int, v string"), "replace")
    assert rows(table.read()) == [(5, "z", None)]
    assert len(rows(before)) == 4, "a reader keeps the state it opened"
    assert table.version() == 4
    with pytest.raises(ValueError):
        table.load(before, "merge", [])
    with pytest.raises(ValueError, match="unknown load mode"):
        table.load(before, "upsert")


def test_merging_twice_changes_nothing(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.range(5).withColumn("v", F.lit("old")))
    staging = spark.range(3, 8).withColumn("v", F.lit("new"))
    table.merge(staging, ["id"])
    once = rows(table.read())
    table.merge(staging, ["id"])
    assert rows(table.read()) == once


def test_a_merge_leaves_folders_without_arriving_keys(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.range(0, 5).withColumn("v", F.lit("a")))
    table.append(spark.range(5, 10).withColumn("v", F.lit("b")))
    table.append(spark.sql("SELECT CAST(NULL AS LONG) AS id, 'n' AS v"))
    first, second, third = table._current().folders
    table.merge(spark.range(7, 12).withColumn("v", F.lit("c")), ["id"])
    folders = table._current().folders
    assert folders[:2] == [first, third] and second not in folders and len(folders) == 3
    table.merge(spark.sql("SELECT CAST(NULL AS LONG) AS id, 'm' AS v, 1 AS extra"), ["id"])
    assert table._current().folders[:3] == folders, "new keys are appended"
    expected = [(n, "a" if n < 5 else "b" if n < 7 else "c", None) for n in range(12)] + [(None, "n", None), (None, "m", 1)]
    assert rows(table.read()) == sorted(expected, key=repr)
    table.replace(table.read())
    assert len(table._current().folders) == 1 and rows(table.read()) == sorted(expected, key=repr)


def test_a_second_writer_is_noticed(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.range(1))
    seen = table._current()
    SnapshotTable(spark, str(tmp_path / "t")).append(spark.range(1))
    with pytest.raises(ConcurrentCommit):
        table._commit(seen, [], table.schema(), None)


def files_of(table):
    return {f: set(os.listdir(f"{table.path}/{f}")) for f in table._current().folders}


@pytest.mark.parametrize("layout", [{"partition_by": ["period"]}, {"bucket_by": ["period"], "buckets": 64}])
def test_merge_rewrites_only_touched_parts(spark, rows, tmp_path, layout):
    table = SnapshotTable(spark, str(tmp_path / "facts"), **layout)
    first = spark.createDataFrame([("01", 1, "a"), ("01", 2, "b"), ("02", 1, "c"), (None, 1, "n")], "period string, k int, v string")
    table.merge(first, ["period", "k"])
    before = files_of(table)
    again = [("02", 1, "C"), ("03", 1, "d"), (None, 1, "m")]
    table.merge(spark.createDataFrame(again, "period string, k int, v string"), ["period", "k"])
    assert rows(table.read(), "period", "k", "v") == sorted(
        [("01", 1, "a"), ("01", 2, "b"), ("02", 1, "C"), ("03", 1, "d"), (None, 1, "n"), (None, 1, "m")], key=repr
    )
    kept = {f: n for f, n in files_of(table).items() if f in before}
    assert len(kept) == 1 and all(before[f] == n for f, n in kept.items())
    with pytest.raises(ValueError):
        table.merge(first, ["k"])
    with pytest.raises(ValueError):
        SnapshotTable(spark, "x", bucket_by=["a"])


def test_a_merge_that_dies_before_its_commit_can_be_replayed(spark, rows, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"), partition_by=["p"])
    df = spark.range(6).select((F.col("id") % 3).alias("p"), "id", F.lit("old").alias("v"))
    table.merge(df, ["p", "id"])
    fresh = df.filter("id < 3").withColumn("v", F.lit("new"))

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(SnapshotTable, "_commit", dies)
        table.merge(fresh, ["p", "id"], "tag")
    assert not table.has_commit("tag") and {v for _, v in rows(table.read(), "id", "v")} == {"old"}
    table.merge(fresh, ["p", "id"], "tag")
    assert table.has_commit("tag") and rows(table.read(), "id", "v") == [(n, "new" if n < 3 else "old") for n in range(6)]


@pytest.mark.parametrize("left", ["", '{"version": 2, "tag": null, "folders": ["data/x"', None])
def test_a_writer_that_died_in_its_commit_blocks_nobody(spark, rows, tmp_path, monkeypatch, left):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, "a")], "k int, v string"))
    if left is None:  # died between the file and its name
        with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
            patch.setattr(SnapshotTable, "_renamed", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
            table.append(spark.createDataFrame([(9, "z")], "k int, v string"), tag="s#4")
    else:  # as an older writer may have left it
        (tmp_path / "t" / "commits" / "000000000002.json").write_text(left)
    assert table.version() == 1 and rows(table.read()) == [(1, "a")] and not table.has_commit("s#4")
    table.append(spark.createDataFrame([(2, "b")], "k int, v string"), tag="s#4")
    table.merge(spark.createDataFrame([(1, "c")], "k int, v string"), ["k"])
    assert rows(table.read()) == [(1, "c"), (2, "b")] and table.has_commit("s#4") and table.has_commit("s#3") and not table.has_commit("s#5")


def test_a_name_is_given_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.range(1))
    stale = table._current()
    table.append(spark.range(1))
    with pytest.raises(ConcurrentCommit):
        table._commit(stale, [], table.schema(), None)
    files, log = table._log()
    path = spark._jvm.org.apache.hadoop.fs.Path
    first, second = (files.makeQualified(path(log, f"00000000000{n}.json")) for n in (1, 2))
    before = (tmp_path / "t" / "commits" / "000000000002.json").read_text()
    with pytest.raises(Exception, match="exists"):
        table._renamed(first, second)
    assert (tmp_path / "t" / "commits" / "000000000002.json").read_text() == before


def test_stores_without_a_safe_rename_are_refused(spark, monkeypatch):
    monkeypatch.setattr(tables, "SAFE_SCHEMES", ("hdfs",))
    with pytest.raises(ValueError, match="one_writer"):
        SnapshotTable(spark, "file:/tmp/none")
    SnapshotTable(spark, "file:/tmp/none", one_writer=True)


def test_readers_never_see_a_batch_that_fails_its_checks(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, "a")], "k int, v string"))
    checks = [{"type": "null_check", "columns": ["v"]}]
    bad, good = ([(1, None), (2, "b")], [(1, "b"), (2, "b")])
    for of_batch, of_table in ((checks, []), ([], checks)):
        with pytest.raises(tables.Rejected) as failed:
            load(table, spark.createDataFrame(bad, "k int, v string"), ["k"], tag="run/7", checks=of_table, batch_checks=of_batch)
        assert rows(table.read()) == [(1, "a")] and table.version() == 1 and not table.has_commit("run/7")
        assert rows(table.rejected(failed.value.tag)) == sorted(bad, key=repr)
    done = load(table, spark.createDataFrame(good, "k int, v string"), ["k"], tag="run/7", checks=checks, batch_checks=checks)
    assert done.rows == 2 and done.verdict == "passed" and table.has_commit("run/7") and rows(table.read()) == good
    with pytest.raises(ValueError, match="tag"):
        load(table, spark.createDataFrame(good, "k int, v string"), ["k"], batch_checks=checks)


def test_a_batch_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.range(5))
    table.merge(spark.range(3, 8).select(F.udf(count, "long")("id").alias("id")), ["id"])
    assert seen.value == 5


def test_misfits_are_an_error_unless_asked_for(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, "a")], "k int, v string"))
    large = spark.createDataFrame([(5_000_000_000, "b")], "k long, v string")
    for load in (lambda: table.append(large), lambda: table.merge(large, ["k"], lossy=True)):
        with pytest.raises(Exception, match="does not fit int"):
            load()
    table.append(large, lossy=True)
    assert rows(table.read()) == sorted([(1, "a"), (None, "b")], key=repr)


def test_clustered_files_cover_ranges_and_split_equal_keys(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    layers.clustered(df, ["k"], num_files=6).write.parquet(path)
    spans = []
    for file in (tmp_path / "c").glob("*.parquet"):
        values = pq.read_table(file)["k"].to_pylist()
        assert values == sorted(values)
        spans.append((values[0], values[-1], len(values)))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(s[2] for s in spans) == 30_000
    assert max(s[2] for s in spans) < 9_000, "a third of all rows share a key; they must not end up in one file"


def test_timestamps_are_written_in_microseconds(spark, tmp_path):
    layers.write_parquet(spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS t"), str(tmp_path / "t"))
    (file, *_) = (tmp_path / "t").glob("*.parquet")
    column = pq.ParquetFile(file).schema.column(0)
    assert column.physical_type == "INT64" and "MICRO" in str(column.logical_type).upper()
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_types_of_new_tables():
    struct = T.StructType().add("s", T.ShortType()).add("d", T.DecimalType(12, 3)).add("b", T.BinaryType()).add("l", T.LongType())
    assert tables.table_schema(struct).simpleString() == "struct<s:string,d:decimal(12,3),b:binary,l:bigint>"


def test_schema_difference():
    a = T.StructType().add("A", "string").add("b", "string")
    assert [f.name for f in new_columns(T.StructType().add("a", "string").add("c", "string"), a)] == ["c"]


def test_concat_matches_names(spark, rows):
    got = concat(spark.sql("SELECT 1 AS a, 2 AS b"), spark.sql("SELECT 3 AS b"), spark.sql("SELECT 1 AS a, 2 AS b"))
    assert rows(got) == sorted([(1, 2), (None, 3), (1, 2)], key=repr)

"""Flattening, naming, trimming, null columns, dedup, declared columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import shape


def test_flatten_appends_leaves_level_by_level(spark):
    df = spark.sql(
        """SELECT named_struct('x', 1, 'deep', named_struct('y', 2, 'z', array(1, 2))) AS a, 'k' AS id,
        map('p', 1) AS m, array(named_struct('q', 1), named_struct('q', 2)) AS list"""
    )
    flat = shape.flatten(df)
    assert flat.columns == ["id", "m", "list", "a_x", "a_deep_y", "a_deep_z"]
    assert tuple(flat.first()) == ("k", '{"p":1}', '[{"q":1},{"q":2}]', 1, 2, "[1,2]")


def test_flatten_keeps_nulls_and_odd_names(spark):
    df = spark.sql("SELECT CAST(NULL AS STRUCT<`v.1`: INT, `w/x`: STRING>) AS `my s`, named_struct('a`b', 1) AS t")
    flat = shape.flatten(df)
    assert flat.columns == ["my s_v.1", "my s_w/x", "t_a`b"]
    assert tuple(flat.first()) == (None, None, 1)


def test_flatten_goes_to_the_last_level(spark):
    value = "1"
    for level in reversed(range(14)):
        value = f"named_struct('l{level}', {value})"
    flat = shape.flatten(spark.sql(f"SELECT {value} AS a"))
    assert flat.columns == ["a_" + "_".join(f"l{n}" for n in range(14))]
    assert tuple(flat.first()) == (1,)


def test_dedup_keeps_the_same_row_whatever_the_order(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "c"), (None, "x"), (None, "y")], "k int, v string")
    once = rows(shape.dedup(df, "k"))
    assert len(once) == 3
    assert all(rows(shape.dedup(df.orderBy(*order).repartition(n), "k")) == once for order, n in ((["v"], 1), ([df.v.desc()], 5)))


def test_colliding_names_get_a_number(spark):
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b, 3 AS A_B_2")
    assert shape.flatten(df).columns == ["a_b", "A_B_2", "a_b_3"]
    tidy = shape.tidy_names(spark.sql("SELECT 1 AS `a/b`, 2 AS `a_b`, 3 AS `A.B`, 4 AS `x-y z`"))
    assert tidy.columns == ["a_b", "a_b_2", "a_b_3", "x_y_z"]
    assert tuple(tidy.first()) == (1, 2, 3, 4)


def test_trim_takes_spaces_only(spark):
    df = spark.createDataFrame([("  a b ", "\tc\n", 1)], "s string, t string, `n.m` int")
    assert tuple(shape.trim_strings(df).first()) == ("a b", "\tc\n", 1)


def test_null_columns_go(spark):
    df = spark.createDataFrame([(1, None, None, ""), (2, None, "x", "")], "id int, `gone.a` string, some string, empty string")
    assert shape.drop_null_columns(df).columns == ["id", "some", "empty"]
    assert shape.drop_null_columns(df.limit(0)).columns == df.columns


def test_dedup(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), (None, 1, "n1"), (None, 3, "n2"), ("b", 1, "only")], "k string, v int, t string"
    )
    assert rows(shape.dedup(df, "k", [F.col("v").desc()])) == rows(df.filter("t IN ('new', 'n2', 'only')"))
    assert shape.dedup(df, "k").count() == 3
    assert shape.dedup(df, "missing").count() == 5
    assert shape.dedup(df, "K", [F.col("v").desc()]).count() == 3


def test_dedup_of_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = shape.dedup(df, "k", [F.col("v").desc()])
    assert kept.count() == 20_001
    assert kept.filter("k = -1").first().v == 29_997


def test_declared_columns(spark):
    schema = T.StructType().add("id", "string").add("level", "integer").add("path", "string").add("parent_id", "string")
    df = spark.createDataFrame([("abcdef", "7", "x"), ("g", "high", "y")], "ID string, Level string, extra string")
    got = shape.to_declared(df, schema, {"id": 3})
    assert got.columns == ["id", "level", "path", "parent_id"]
    assert [tuple(r) for r in got.collect()] == [("abc", 7, None, None), ("g", None, None, None)]
    assert shape.with_declared_columns(df, schema).columns == ["ID", "Level", "extra", "path", "parent_id"]


def test_dimension_records(spark):
    df = spark.sql("SELECT 'i' AS id, named_struct('id', 'p', 'displayName', 'P') AS parent, array('g', 'h') AS groupIds")
    got = shape.flatten_dimension(df)
    assert got.columns == ["id", "groupids", "parent_id", "parent_displayname"]
    assert tuple(got.first()) == ("i", '["g","h"]', "p", "P")


def test_lineage(spark):
    df = shape.processed_lineage(spark.range(1), "e", "t", "p", "c", "now")
    df = shape.curated_lineage(df, "e", "later")
    assert df.columns[1:] == [
        "_pipeline_execution_id", "_ingestion_timestamp", "_pipeline_name", "_country", "_processed_at",
        "_curated_at", "_curated_execution_id",
    ]
    assert {t for _, t in df.dtypes[1:]} == {"string"}


def test_landed_documents_are_compressed_files_of_some_rows(spark, tmp_path, monkeypatch, rows):
    from tierline.sinks import layers
    from tierline.sources import files

    monkeypatch.setattr(layers, "LANDED_DOCUMENTS", 100)
    docs = spark.range(950).select(F.struct("id", F.lit("é }\n").alias("text")).alias("doc")).coalesce(1)
    layers.land_documents(docs, "doc", str(tmp_path / "raw"))
    assert len(list((tmp_path / "raw").glob("part-*.json.gz")) or list((tmp_path / "raw").glob("part-*.gz"))) == 10
    assert rows(files.read_json(spark, str(tmp_path / "raw"), "id long, text string")) == sorted(((i, "é }\n") for i in range(950)), key=repr)

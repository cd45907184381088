"""SQL texts over batches, views, and the batch jobs."""

import pytest
from pyspark.sql import functions as F

from tierline.operators import runs
from tierline.plans import batch, steps
from tierline.sinks import layers

TEXT = """
-- header comment
SELECT ignored;
-- transform_one
-- why
SELECT a, a + 1 AS b -- tail
FROM __TABLE__;

  -- transform_two
SELECT b * 2 AS c
   -- indented comment
FROM __TABLE__
-- transform_empty
-- nothing
"""


def test_splitting():
    assert steps.split_steps(TEXT) == [
        ("transform_one", "SELECT a, a + 1 AS b -- tail\nFROM __TABLE__;"),
        ("transform_two", "SELECT b * 2 AS c\nFROM __TABLE__"),
    ]
    assert steps.split_steps("SELECT 1") == []


def test_running(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows(steps.run_steps(df, TEXT)) == [(4,), (6,)]
    assert rows(steps.run_steps(df, "SELECT processed_data.a, '{x}' AS t FROM processed_data;")) == [(1, "{x}"), (2, "{x}")]
    assert rows(steps.run_sql(df, "SELECT count(*) AS n FROM `source_data`")) == [(2,)]
    assert steps.run_steps(df, None) is df and steps.run_steps(df, "  ") is df


def test_steps_of_two_batches_do_not_meet(spark, rows):
    one = steps.run_steps(spark.createDataFrame([(1,)], "a int"), "SELECT a AS x FROM processed_data")
    two = steps.run_steps(spark.createDataFrame([(2,)], "a int"), "SELECT a AS x FROM processed_data")
    assert (rows(one), rows(two)) == ([(1,)], [(2,)])


def test_views_run_in_name_order(spark):
    done = steps.refresh_views(
        spark,
        {"v_b": "SELECT n + 1 AS n FROM v_a", "v_a": "SELECT 1 AS n;", "v_c": "", "x": lambda s: s.range(1)},
        select="v_",
    )
    assert done == ["v_a", "v_b"]
    assert spark.table("v_b").first().n == 2
    steps.refresh_views(spark, {"v_b": "SELECT 'other' AS columns_now"})
    assert spark.table("v_b").columns == ["columns_now"]


RUN = batch.Run("survey", "run-7", "2024-06-15T10:30:00", "liberia", now="2024-06-15T11:00:00")


def test_raw_to_curated(spark, rows, tmp_path):
    raw = spark.sql(
        """SELECT explode(array(
        named_struct('_id', 1, 'grp/a b', ' x ', 'geo', array(1.5D, 2.5D), 'never', CAST(NULL AS STRING), 'v', named_struct('k-1', 'y')),
        named_struct('_id', 1, 'grp/a b', ' x ', 'geo', array(1.5D, 2.5D), 'never', CAST(NULL AS STRING), 'v', named_struct('k-1', 'y')))) AS r"""
    ).select("r.*")
    processed = batch.processed(raw, RUN, dedup_key="_id", cleaning_sql="SELECT *, upper(grp_a_b) AS up FROM source_data")
    assert processed.columns == [
        "_id", "grp_a_b", "geo", "v_k_1", "_pipeline_execution_id", "_ingestion_timestamp", "_pipeline_name", "_country",
        "_processed_at", "up",
    ]
    assert rows(processed, "_id", "grp_a_b", "geo", "v_k_1", "up") == [(1, "x", "[1.5,2.5]", "y", "X")]

    path = batch.write_layer(processed, str(tmp_path / "processed"), RUN, str(tmp_path / "audit"), "processed")
    assert path.endswith("/processed/liberia/survey/2024/06/15/run-7/")
    curated = batch.curated(spark.read.parquet(path), RUN, "-- transform_x\nSELECT *, array(1) AS list FROM __TABLE__;")
    assert curated.columns[-3:] == ["list", "_curated_at", "_curated_execution_id"]
    assert rows(curated, "list", "_curated_at") == [("[1]", "2024-06-15T11:00:00")]

    (audit,) = spark.read.schema(runs.AUDIT_SCHEMA).json(str(tmp_path / "audit")).collect()
    assert (audit.status, audit.row_count, audit.column_count, audit.path) == ("processed_complete", 1, 10, path)
    assert audit.schema_columns.startswith('["_id","grp_a_b"')


def test_a_batch_may_be_empty(spark, tmp_path):
    empty = spark.createDataFrame([], "_id int, note string")
    processed = batch.processed(empty, RUN, dedup_key="_id")
    assert processed.columns[:2] == ["_id", "note"]
    batch.write_layer(processed, str(tmp_path / "p"), RUN, str(tmp_path / "audit"), "processed")
    assert spark.read.json(str(tmp_path / "audit")).first().row_count == 0


def test_a_failure_is_recorded(spark, tmp_path):
    broken = spark.range(1).select(F.raise_error(F.lit("no good")).alias("x"))
    with pytest.raises(Exception, match="no good"):
        batch.write_layer(broken, str(tmp_path / "p"), RUN, str(tmp_path / "audit"), "curated")
    record = spark.read.schema(runs.AUDIT_SCHEMA).json(str(tmp_path / "audit")).first()
    assert record.status == "curated_failed" and "no good" in record.error_message and record.row_count is None


def test_layer_paths():
    assert layers.layer_path("c", "p", "e", "2024-01-05T00:00:00") == "c/p/2024/01/05/e/"
    assert layers.layer_path("c", "p", "e", "2024-01-05", "units") == "c/p/dimensions/units/2024/01/05/e/"


def test_full_and_incremental_layer_writes(spark, tmp_path):
    path = str(tmp_path / "x")
    for full, expected in [(False, 1), (False, 2), (True, 1)]:
        layers.write_parquet(spark.range(1), path, full)
        assert spark.read.parquet(path).count() == expected


def test_partitioned_layer_replaces_only_its_folders(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    for run, n in [("r1", 2), ("r2", 3), ("r1", 1)]:
        df = layers.with_layer_columns(spark.range(n), "c", "p", run, "2024-02-03T00:00:00")
        layers.write_partitioned(df, root, one_folder=True)
    counts = spark.read.parquet(root).groupBy("execution_id", "year", "month", "day").count()
    assert rows(counts) == [("r1", 2024, 2, 3, 1), ("r2", 2024, 2, 3, 3)]


def test_literals_comments_and_aliases_are_left_alone(spark):
    spark.sql("SELECT 9 AS mine").createOrReplaceTempView("processed_data")
    df = spark.sql("SELECT 1 AS id")
    text = "-- source_data\nSELECT id AS source_data, 'source_data' AS origin, '{x}' AS braces /* __TABLE__ */ FROM source_data"
    got = steps.run_sql(df, text)
    assert got.columns == ["source_data", "origin", "braces"] and tuple(got.first()) == (1, "source_data", "{x}")
    assert tuple(spark.table("processed_data").first()) == (9,), "a view of that name comes back"
    spark.catalog.dropTempView("processed_data")
    assert not spark.catalog.tableExists("source_data")


def test_statements_from_files(spark, tmp_path):
    for name, text in (("b_two.sql", "SELECT n + 1 AS n FROM a_one;"), ("a_one.sql", "SELECT 1 AS n"), ("c.sql", "  \n"), ("d.txt", "nonsense")):
        (tmp_path / name).write_text(text)
    assert steps.refresh_views_from(spark, str(tmp_path)) == ["a_one", "b_two"]
    assert spark.table("b_two").first().n == 2
    assert steps.refresh_views_from(spark, str(tmp_path), "a*.sql") == ["a_one"]
    done = steps.load_with_statements(lambda: None, spark, after=[str(tmp_path / "a_one.sql"), ("x", "SELECT 5 AS n FROM a_one")])
    assert done == ["a_one", "x"]

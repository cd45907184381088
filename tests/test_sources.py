"""File scans and response envelopes."""

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierline.sources import envelopes, files


def _write(folder: Path, name: str, text: str, encoding="utf-8", age: int = 0) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text, encoding=encoding)
    if age:
        os.utime(path, (time.time() - age, time.time() - age))
    return path


def _docs(spark, tmp_path, *documents):
    _write(tmp_path, "docs.json", "\n".join(json.dumps(d) for d in documents))
    return files.read_json(spark, str(tmp_path / "docs.json"))


def test_array_document_over_several_lines(spark, tmp_path):
    path = _write(tmp_path, "a.json", '[\n {"a": 1, "é": "ü"},\n {"a": 2}\n]')
    assert sorted(r.a for r in files.read_json(spark, str(path), multi_line=True).collect()) == [1, 2]
    flat = _write(tmp_path, "b.json", '[{"a": 1}, {"a": 2}]\n[]\n[{"a": 3}]')
    assert sorted(r.a for r in files.read_json(spark, str(flat), "a int").collect()) == [1, 2, 3]


def test_mixed_types_and_empty_objects(spark, tmp_path):
    df = _docs(spark, tmp_path, {"a": 1, "e": {}, "n": None}, {"a": "x"})
    assert dict(df.dtypes) == {"a": "string", "n": "string"}


def test_csv_with_inference(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "id,name\n1,x\n2,y\n")
    assert files.read_csv(spark, str(path)).dtypes == [("id", "int"), ("name", "string")]


def test_pick_up_is_text_only_and_keeps_empty_fields(spark, tmp_path, rows):
    _write(tmp_path, "one.csv", 'id;name;note\n1;Zoë;\n02;"a;b";x\n', "latin-1")
    _write(tmp_path / "deeper", "TWO.CSV", "id;name;note\n3;c;y\n", "latin-1")
    _write(tmp_path, "empty.csv", "")
    _write(tmp_path, "other.txt", "id;name;note\n9;9;9\n")
    df = files.pick_up_csv(spark, str(tmp_path), sep=";", encoding="latin1")
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("02", "a;b", "x"), ("1", "Zoë", ""), ("3", "c", "y")]


def test_pick_up_refuses_other_headers_unless_told(spark, tmp_path, rows):
    _write(tmp_path, "a file.csv", "id,name\n1,x\n")
    _write(tmp_path, "b.csv", "name,id,extra\ny,2,z\n")
    with pytest.raises(Exception, match="header"):
        files.pick_up_csv(spark, str(tmp_path)).collect()
    got = files.pick_up_csv(spark, str(tmp_path), mixed_headers=True)
    assert rows(got, "id", "name", "extra") == [("1", "x", None), ("2", "y", "z")]


def test_pick_up_of_quoted_fields(spark, tmp_path, rows):
    _write(tmp_path, "q.csv", '\ufeffid,note\n1,"say ""hi"", \\ok"\n2,"two\nlines"\n\n3, padded \n')
    df = files.pick_up_csv(spark, str(tmp_path), encoding="utf-8-sig", multi_line=True)
    assert rows(df, "id", "note") == [("1", 'say "hi", \\ok'), ("2", "two\nlines"), ("3", " padded ")]


def test_lines_of_another_length(spark, tmp_path, rows):
    _write(tmp_path, "a.csv", "a,b,c\n1,,\n2,x\n3,x,y,z\n")
    assert rows(files.pick_up_csv(spark, str(tmp_path), drop_surplus=True)) == [("1", "", ""), ("2", "x", None), ("3", "x", "y")]
    with pytest.raises(Exception, match="more cells than the header has: 3,x,y,z"):
        files.pick_up_csv(spark, str(tmp_path)).collect()


def test_pick_up_after_a_watermark(spark, tmp_path, rows):
    old = _write(tmp_path, "old.csv", "id\n1\n", age=3600)
    _write(tmp_path, "new.csv", "id\n2\n")
    first = files.pick_up_csv(spark, str(tmp_path), file_columns=True)
    times = {Path(r._file).name: r._modified for r in first.collect()}
    seen = times["old.csv"].isoformat(timespec="milliseconds")
    assert rows(files.pick_up_csv(spark, str(tmp_path), modified_after=seen)) == [("2",)]
    assert files.newest_file_time(first).first()[0] == times["new.csv"]
    late = files.pick_up_csv(spark, str(tmp_path), modified_after="2999-01-01T00:00:00", file_columns=True)
    assert late.isEmpty() and files.newest_file_time(late).first()[0] is None
    none = files.pick_up_csv(spark, str(tmp_path), modified_after="2999-01-01T00:00:00", mixed_headers=True, columns=["id"])
    assert none.columns == ["id"] and none.isEmpty()
    assert old.exists()


def test_results_envelope(spark, tmp_path, rows):
    df = _docs(spark, tmp_path, {"count": 2, "results": [{"a": 1}, {"a": 2, "b": "x"}]}, {"results": []}, {"results": None})
    assert rows(envelopes.explode_results(df), "a", "b") == [(1, None), (2, "x")]
    plain = spark.range(2)
    assert envelopes.explode_results(plain) is plain


def test_dotted_path(spark, tmp_path, rows):
    df = _docs(spark, tmp_path, {"r": {"data": {"items": [{"a": 1}, {"a": 2}]}}}, {"r": {"data": None}})
    assert rows(envelopes.at_path(df, "r.data.items")) == [(1,), (2,)]
    assert envelopes.at_path(df, "r.nothing.items").isEmpty()
    assert rows(envelopes.dimension_records(_docs(spark, tmp_path, {"orgs": [{"id": "a"}], "pager": {}}), "orgs")) == [("a",)]
    assert envelopes.dimension_records(df, "absent").isEmpty()


def test_generic_container_order(spark, tmp_path, rows):
    df = _docs(spark, tmp_path, {"results": [{"a": 1}], "data": [{"a": 9}]}, {"data": [{"a": 2}]}, {"a": 3})
    assert rows(envelopes.first_container(df), "a") == [(1,), (2,), (3,)]
    bare = _docs(spark, tmp_path, {"a": 1}, {"a": 2})
    assert rows(envelopes.first_container(bare)) == [(1,), (2,)]
    assert rows(envelopes.first_container(bare, columns=["a", "b"])) == [("1", None), ("2", None)]
    mixed = _docs(spark, tmp_path, {"results": [{"a": 1, "l": [1]}, None]}, {"data": [{"a": "x", "l": "y"}]}, {"data": []})
    assert rows(envelopes.first_container(mixed), "a", "l") == sorted([("1", "[1]"), (None, None), ("x", "y")], key=repr)
    values = _docs(spark, tmp_path, {"results": [1, 2]})
    assert rows(envelopes.first_container(values)) == [(1,), (2,)]
    single = _docs(spark, tmp_path, {"data": {"a": 1}})
    assert rows(envelopes.first_container(single)) == [(1,)]


def test_rows_by_header(spark, tmp_path):
    df = _docs(
        spark,
        tmp_path,
        {
            "headers": [{"name": "dx"}, {"column": "Period"}, {"other": "?"}, {"name": "v"}, {"name": "v"}],
            "rows": [["a", "b", "c", "d", "e", "beyond"], ["short"]],
        },
    )
    got = envelopes.zip_rows(df, ["dx", "Period", "col_2", "v", "absent"]).collect()
    assert [tuple(r) for r in got] == [("a", "b", "c", "e", None), ("short", None, None, None, None)]


def test_tracker_containers(spark, tmp_path, rows):
    df = _docs(
        spark,
        tmp_path,
        {"headers": [{"name": "id"}], "rows": [["1"]]},
        {"dataValues": [{"id": "2"}, {"id": "3"}]},
        {"trackedEntityInstances": [{"id": "4"}]},
        {"events": [{"id": "5"}], "id": "not this"},
        {"id": "6"},
    )
    got = envelopes.first_container(df, envelopes.TRACKER_CONTAINERS, ["id"])
    assert rows(got) == [(str(n),) for n in range(1, 7)]


def test_run_scans(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    df = spark.range(6).select(F.col("id"), F.concat(F.lit("run-"), (F.col("id") % 2).cast("string")).alias("execution_id"))
    df.write.partitionBy("execution_id").parquet(root)
    one = files.read_run(spark, root, "run-1")
    assert rows(one, "id") == [(1,), (3,), (5,)]
    below = files.read_below(spark, root, "execution_id=run-0/")
    assert rows(below) == [(0, "run-0"), (2, "run-0"), (4, "run-0")]
    assert all("run-0" in f for f in below.inputFiles())


def test_run_ids_are_strings(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    ids = ["007", "7", "a=b/c 1", "[x]"]
    df = spark.createDataFrame([("z", i, n) for n, i in enumerate(ids)], "country string, execution_id string, n int")
    df.write.partitionBy("country", "execution_id").parquet(root)
    for n, i in enumerate(ids):
        one = files.read_run(spark, root, i)
        assert rows(one, "n", "execution_id") == [(n, i)]
        assert len(one.inputFiles()) == 1
    assert files.read_run(spark, root, "77").collect() == []
    assert rows(files.read_below(spark, root, "country=z/execution_id=007"), "n", "execution_id", "country") == [(0, "007", "z")]


def test_headers_in_another_encoding_and_of_new_files_only(spark, tmp_path, rows):
    for name, text in (("a.csv", "é,b\n1,2\n"), ("b.csv", "è,b\n3,4\n")):
        (tmp_path / name).write_bytes(text.encode("latin-1"))
    got = files.pick_up_csv(spark, str(tmp_path), encoding="latin-1", mixed_headers=True)
    assert rows(got.select("é", "è", "b")) == sorted([("1", None, "2"), (None, "3", "4")], key=repr)

    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "old.csv").write_text("x,y\n" + "1,2\n" * 500)
    (drop / "new.csv").write_text("p,q,r\n1,2,3\n")
    os.utime(drop / "old.csv", (1e9, 1e9))
    got = files.pick_up_csv(spark, str(drop), modified_after="2010-01-01T00:00:00")
    assert got.columns == ["p", "q", "r"] and rows(got) == [("1", "2", "3")]


def test_line_breaks_in_quotes_by_default(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('k,t\n1,"two\nlines"\n2,one\n')
    assert rows(files.pick_up_csv(spark, str(tmp_path))) == [("1", "two\nlines"), ("2", "one")]


def test_union_of_run_schemas(spark, tmp_path, rows):
    root = str(tmp_path / "runs")
    spark.sql("SELECT 1 AS a").write.parquet(f"{root}/2024/01/01/r1")
    spark.sql("SELECT 2 AS a, 'x' AS b").write.parquet(f"{root}/2024/01/02/r2")
    assert rows(files.read_all_runs(spark, root), "a", "b") == [(1, None), (2, "x")]
    assert rows(files.read_all_runs(spark, root, "a int, b string, c int"), "a", "c") == [(1, None), (2, None)]


def test_a_folder_nobody_wrote(spark, tmp_path):
    assert files.read_if_exists(spark, str(tmp_path / "no"), "a int").isEmpty()


def test_headers_are_read_without_the_rest_of_the_files(spark, rows, tmp_path):
    """Files of two layouts in latin-1; what is read of them does not depend on their size."""
    small = _write(tmp_path / "d", "a.csv", "clé;name\n1;é\n", encoding="latin-1")
    (tmp_path / "d" / "sub").mkdir()
    _write(tmp_path / "d" / "sub", "b.CSV", "größe;clé\r\n" + "ü;2\r\n" * 2_000_000, encoding="latin-1")
    _write(tmp_path / "d", "c.csv", "", encoding="latin-1")
    lines = {r.path.rpartition("/")[2]: bytes(r.line) for r in files._first_lines(spark, str(tmp_path / "d")).collect()}
    assert lines == {"a.csv": "clé;name".encode("latin-1"), "b.CSV": "größe;clé".encode("latin-1")}
    assert files._first_lines(spark, str(tmp_path / "d")).rdd.getNumPartitions() >= 2
    df = files.pick_up_csv(spark, str(tmp_path / "d"), sep=";", encoding="latin-1", mixed_headers=True, multi_line=False)
    assert df.groupBy("clé", "name", "größe").count().count() == 2 and df.count() == 2_000_001
    assert rows(df.filter("name is not null"), "clé", "name") == [("1", "é")]
    assert small.exists()

"""Array documents cut by byte ranges, against the reader that takes a file as a whole."""

import json
import random

import pytest
from pyspark.errors import PythonException

from tierline.sinks import layers
from tierline.sources import arrays, files

SCHEMA = "id long, text string, list array<string>, deep struct<a:struct<b:string>, c:array<struct<d:int>>>"
HARD = ["", "plain", "}", "]", "}{][", '"', '\\"}', "\\", "\\\\", '\\"', "{\"id\": 9}", "é\U0001f600}", "a\nb\t}", '},{"', "[" * 9, " }"]


def records(n, seed=1):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(HARD) for _ in range(rng.randint(0, 6)))
    for i in range(n):
        deep = rng.choice([None, {}, {"a": {"b": text()}, "c": [{"d": k} for k in range(rng.randint(0, 3))]}])
        yield {"id": i, "text": text(), "list": [text() for _ in range(rng.randint(0, 3))], "deep": deep}


@pytest.fixture
def ranges(spark):
    """Byte ranges of a chosen size."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def choose(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield choose
    for k, v in kept.items():
        spark.conf.set(k, v)


def both(spark, path):
    whole = files.read_json(spark, str(path), SCHEMA, multi_line=True)
    split = arrays.read_json_array(spark, str(path), SCHEMA)
    assert split.schema == whole.schema
    return sorted(map(repr, split.collect())), sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("style", [{"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}])
@pytest.mark.parametrize("size", [61, 2503])
def test_equals_the_whole_reader(spark, tmp_path, ranges, size, style):
    n = 40 if size < 100 else 400
    for name, rows in (("a", records(n)), ("b", records(n // 2, 2)), ("c", []), ("d", records(1))):
        (tmp_path / f"{name}.json").write_text(json.dumps(list(rows), **style), encoding="utf-8")
    (tmp_path / "e.json").write_text(" \n[ ]\n")
    (tmp_path / "f.json").write_text("")
    ranges(size)
    split, whole = both(spark, tmp_path)
    assert split == whole
    assert len(whole) == n + n // 2 + 1


def test_one_file_is_many_tasks_and_no_text_moves(spark, tmp_path, ranges):
    (tmp_path / "a.json").write_text(json.dumps(list(records(3000))))
    ranges((tmp_path / "a.json").stat().st_size // 10)
    assert arrays.fragments(spark, str(tmp_path)).rdd.getNumPartitions() >= 8
    split, whole = both(spark, tmp_path)
    assert split == whole and len(whole) == 3000
    plan = arrays.fragments(spark, str(tmp_path)).mapInArrow(arrays._cuts, "path string")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_states_by_shuffle_beyond_the_broadcast(spark, tmp_path, ranges, monkeypatch):
    monkeypatch.setattr(arrays, "BROADCAST_RANGES", 0)
    (tmp_path / "a.json").write_text(json.dumps(list(records(300))))
    ranges(997)
    split, whole = both(spark, tmp_path)
    assert split == whole


def test_an_element_over_many_ranges(spark, tmp_path, ranges):
    rows = [{"id": 1, "text": "}" * 5000}, {"id": 2, "text": '\\"' * 5000}, {"id": 3, "list": ["x" * 9000, "]"]}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    ranges(101)
    split, whole = both(spark, tmp_path)
    assert split == whole and len(whole) == 3


@pytest.mark.parametrize("text", ['{"id": 1}', "[1, 2]", '[{"id": 1}, 2, {"id": 3}]', '[{"id": 1}, "}"]', '[[{"id": 1}]]', '"[{}]"'])
def test_other_documents_are_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(PythonException, match="array"):
        arrays.read_json_array(spark, str(tmp_path), SCHEMA).collect()


def test_landed_arrays_come_back(spark, tmp_path):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(HARD)], "id long, text string, list array<string>").repartition(3)
    layers.land_array(df, str(tmp_path / "landed"))
    assert len(list((tmp_path / "landed").glob("part-*"))) == 3
    for path in (tmp_path / "landed").glob("part-*"):
        assert {"id", "text", "list"} == {k for r in json.loads(path.read_text(encoding="utf-8")) for k in r}
    split, whole = both(spark, tmp_path / "landed")
    assert split == whole and len(split) == len(HARD)
    layers.land_array(df.limit(0), str(tmp_path / "none"))
    assert arrays.read_json_array(spark, str(tmp_path / "none"), SCHEMA).collect() == []


def test_working_arrays_are_bounded_whatever_the_batch(spark, tmp_path):
    rows = [{"id": i, "text": HARD[i % len(HARD)] * 40 + "x" * 5000} for i in range(2000)]
    text = json.dumps(rows)
    (tmp_path / "a.json").write_text(text)
    values = text.split("}")
    batch = arrays.pa.RecordBatch.from_arrays([["a"] * len(values), [0] * len(values), values], ["path", "start", "value"])
    sizes = [sum(map(len, part.column("value").to_pylist())) for _, _, part in arrays._parts(iter([batch]))]
    assert sum(sizes) == sum(map(len, values)) and len(sizes) > 5
    assert max(sizes) <= 2 * arrays.RUN_BYTES
    split, whole = both(spark, tmp_path)
    assert split == whole and len(whole) == 2000

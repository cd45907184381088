"""Near-duplicate classes against all pairs, and the signature against the similarity it estimates."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tierline.llm import bagminhash
from tierline.llm.flat import mixed

SF = "/root/testdata/sf0.001"


def bag(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4)) if len(found) > 4 else Counter([tuple(found)] * bool(found))


def brute(rows):
    """Class of each row as the set of rows that links join; equal texts are linked."""
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, any_ = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (any_ and both >= 0.8 * any_):
                root[max(of(i), of(j))] = min(of(i), of(j))
    return [of(i) for i in range(len(rows))]


def agree(told, rows):
    wanted = brute(rows)
    keys = {}
    for (k, _), c in zip(rows, wanted):
        keys.setdefault(c, []).append(k)
    expected = {k: (min(keys[c]), len(keys[c])) for (k, _), c in zip(rows, wanted)}
    assert {r.doc_id: (r.class_id, r.class_size) for r in told} == expected
    assert Counter(r.class_id for r in told if r.is_first) == Counter({min(v): 1 for v in keys.values()})
    assert all(r.doc_id == r.class_id for r in told if r.is_first)


@pytest.mark.parametrize("heavy", [1, 9, 1000])
def test_registers_agree_as_often_as_the_bags_overlap(heavy):
    keys = mixed(np.arange(60, dtype=np.uint64))
    a, b = np.array([heavy] * 10 + [1] * 50), np.array([max(heavy // 2, 1)] * 10 + [1] * 40 + [3] * 10)
    m = 8000
    regs = bagminhash.signatures(np.concatenate([keys, keys]), np.repeat([0, 1], 60), np.concatenate([a, b]), 3, m)
    wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert (regs[0] == regs[1]).mean() == pytest.approx(wanted, abs=4 * np.sqrt(0.25 / m))
    assert np.isinf(regs[2]).all()


def test_equals_all_pairs_on_the_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    agree(bagminhash.classes(df).collect(), [(r.doc_id, r.text) for r in df.collect()])


def test_groups_of_near_copies(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = []
    for group in range(6):
        base = [word() for _ in range(120)]
        for _ in range(12 if group < 3 else 2):
            changed = list(base)
            for place in rng.sample(range(120), rng.randint(0, 4)):
                changed[place] = word()
            rows.append((len(rows), " ".join(changed)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " ", "one two", "one  two", "x " * 500, "x " * 500, "y", "z" * 40000, "x " * 450])]
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, row int, class_id string").repartition(4)
    done = bagminhash.classes(df)
    assert done.columns == ["doc_id", "text", "row", "class_id", "class_size", "is_first"]
    told = done.collect()
    agree(told, rows)
    assert {r.doc_id: r.text for r in told} == dict(rows)


def test_null_keys_repeated_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (5, "q"), (5, "q"), (None, None)], "doc_id long, text string")
    told = sorted(((r.doc_id, r.text, r.class_id, r.class_size) for r in bagminhash.classes(df).collect()), key=repr)
    assert told == sorted([(None, "a b c d e f", None, 2)] * 2 + [(5, "q", 5, 2)] * 2 + [(None, None, None, 1)], key=repr)
    assert bagminhash.classes(df).filter("is_first").count() == 3
    assert bagminhash.classes(df.limit(0)).collect() == []


def test_hashes_do_not_depend_on_neighbours():
    from tierline.llm.flat import hashed

    letters = np.arange(5000)
    near = hashed(letters, np.array([0, 10]), np.array([5, 7]))
    assert (hashed(letters, np.array([0, 10, 20]), np.array([5, 7, 4000]))[:2] == near).all()


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (202, 201), (202, 200), (300, 300)]
    told = dict(map(tuple, bagminhash.stars(spark.createDataFrame(links, "a long, b long")).collect()))
    assert told == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 160)}, 201: 200, 202: 200}


def test_hashing_takes_memory_by_the_number_of_runs_not_of_letters():
    import tracemalloc

    from tierline.llm.flat import hashed

    lengths = np.tile([3, 9, 2000, 1], 600)
    first = np.cumsum(lengths) - lengths
    letters = np.random.default_rng(1).integers(0, 256, int(lengths.sum())).astype(np.uint8)
    tracemalloc.start()
    told = hashed(letters, first, lengths)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    alone = [hashed(letters, first[i : i + 1], lengths[i : i + 1])[0] for i in range(len(first))]
    assert told.tolist() == [int(x) for x in alone]
    assert most < 12 * len(letters)


def test_a_task_holds_the_registers_of_few_texts():
    class Given:
        schema = T.StructType([T.StructField("text", T.StringType())])

        def mapInArrow(self, run, schema):
            return run

    texts = [f"w{i % 50} a b c d e" for i in range(4000)]
    run = bagminhash.with_signature(Given(), "text", "brief", bagminhash.WIDE, bagminhash.briefed)
    parts = list(run(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    assert [x for p in parts for x in p.column("text").to_pylist()] == texts
    assert max(p.num_rows for p in parts) * bagminhash.WIDE <= 1 << 20
    told = {}
    for p in parts:
        for text, brief in zip(p.column("text").to_pylist(), p.column("brief").to_pylist()):
            assert told.setdefault(text, brief) == brief


def test_components_run_no_round_to_learn_that_the_last_one_was_the_last(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(bagminhash, "checkpointed", lambda df, f=bagminhash.checkpointed: rounds.append(df) or f(df))
    links = [(7, k) for k in range(8, 40)] + [(41, 40), (40, 41), (50, 50), (None, 1), (1, None)]
    told = dict(map(tuple, bagminhash.stars(spark.createDataFrame(links, "a long, b long")).collect()))
    assert told == {**{k: 7 for k in range(8, 40)}, 41: 40}
    assert len(rounds) == 1


def test_components_run_few_tasks(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "20")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(9)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(500)]
    frame = session.createDataFrame(links, "a long, b long").repartition(20)
    context, group = session.sparkContext, "components"
    context.setJobGroup(group, "")
    told = bagminhash.stars(frame)
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    tasks = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    root = {k: k for pair in links for k in pair}

    def of(k):
        return k if root[k] == k else of(root[k])

    for a, b in links:
        root[max(of(a), of(b))] = min(of(a), of(b))
    assert dict(map(tuple, told.collect())) == {k: of(k) for k in root if of(k) != k}
    # Each leaves files on disk: 1653 tasks when every end of a link was joined by itself.
    assert 0 < tasks < 55 * 20

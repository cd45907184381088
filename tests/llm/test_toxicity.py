"""Toxicity: the risk estimator, held-out ranking, odd rows."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import toxicity
from tierline.llm.flat import utf8
from tierline.llm.queries import op6_toxicity

SF = "/root/testdata/sf0.1"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab Cdé1-ß", max_size=20), max_size=6))
def test_words_and_beginnings(texts):
    words, text = toxicity.present(*utf8(pa.array([*texts, "abcde abcde"])))
    import re

    for i, t in enumerate([*texts, "abcde abcde"]):
        runs = re.findall(r"[^\W\d_]+", t.lower())
        plain = set(runs) | {(w[:k], k) for w in runs for k in toxicity.BEGINNINGS if len(w) > k}
        assert (text == i).sum() == len(plain)


def test_training_ignores_toxic_documents_among_the_unlabelled():
    rng = np.random.default_rng(1)
    positive = [np.array([0, 2]) if rng.random() < 0.5 else np.array([1, 2]) for _ in range(300)]
    negative = [np.array([2, 3]) for _ in range(900)]
    unlabelled = negative + [np.array([0, 2])] * 50 + [np.array([1, 2])] * 50
    weights, bias = toxicity.trained(positive, unlabelled, 4, 0.1)
    assert weights[0] + weights[2] + bias > 0 and weights[1] + weights[2] + bias > 0 > weights[2] + weights[3] + bias


def test_held_out_ranking(spark):
    told = op6_toxicity(spark, SF)
    assert told.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = told.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").select("score", "toxic", "predicted").collect()
    assert told.count() == 10_000
    good = np.array([r.score for r in rows if r.toxic])
    other = np.array([r.score for r in rows if not r.toxic])
    area = (good[:, None] > other).mean() + 0.5 * (good[:, None] == other).mean()
    assert area > 0.85
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_odd_rows(spark):
    rows = [(i, "you stupid thing" if i % 4 == 0 else f"kind words here {i}", 7.0) for i in range(200)]
    rows += [(None, None, 1.0), (200, None, 1.0), (201, "", 1.0), (202, "mild " * 30000, 1.0), (0, "you stupid thing", 7.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double").withColumn("toxic", toxicity.F.lit(5))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)] + [(None, 1), (3, None), (0, 1)], "doc_id long, toxic int")
    done = toxicity.score(df, toxicity.fit(df, labels))
    assert done.columns == ["doc_id", "text", "toxic", "score"]
    told = [(r.doc_id, r.score) for r in done.collect()]
    assert len(told) == len(rows) and all(0 <= s <= 1 for _, s in told)
    assert dict(told)[120] > 0.5 > dict(told)[121] and dict(told)[201] < 0.5
    empty = toxicity.fit(df.limit(0), labels)
    assert {r.score for r in toxicity.score(df, empty).collect()} == {0.0}  # not even a prior
    assert toxicity.score(df.limit(0), empty).collect() == []

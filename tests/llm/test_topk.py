"""Top-k against sorting all scores."""

import numpy as np
import pytest

from tierline.llm import topk


def brute(rows, k):
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(b) == len(a))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(512, 4096), (7, 11)])
@pytest.mark.parametrize("kind", ["spread", "ties", "one", "large"])
def test_equals_sorting(spark, monkeypatch, blocks, kind):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(5)
    vectors = {
        "spread": rng.normal(size=(130, 8)),
        "ties": rng.integers(0, 2, size=(130, 3)) / 64,
        "one": np.ones((130, 4)),
        "large": rng.normal(size=(60, 4)) * 1e7,
    }[kind].astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(None, rows[0][1]), (1000, None), (1020, [None] * vectors.shape[1]), (1040, [float("nan")] * vectors.shape[1]), (1060, [float("inf")] * vectors.shape[1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, block string").repartition(3)
    done = topk.search(df, topk.F.col("vec_id") % 20 == 0, k=20)
    assert sorted(tuple(r) for r in done.collect()) == brute(rows, 20)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (20, [2.0]), (3, [1.0, 2.0])], "vec_id long, embedding array<float>")
    asked = topk.F.col("vec_id") % 20 == 0
    done = sorted(tuple(r) for r in topk.search(df, asked, k=5).collect())
    assert done == [(0, 1, 20, 8192), (0, 2, 20, 8192), (20, 1, 0, 8192), (20, 1, 0, 8192)]
    assert topk.search(df.limit(0), asked).collect() == []
    assert topk.search(df.filter("vec_id = 3"), asked).collect() == []

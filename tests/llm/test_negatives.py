"""Hard negatives against sorting all scores, and the pruning against all cosines."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import negatives


def brute(rows, every):
    good = [
        (i, label, [math.floor(256 * float(x)) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, a in good:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, other) for j, other, b in good if len(b) == len(a))
        positives = [(-s, j) for s, j, other in scored if other == label and j != i][:5]
        for p, j in positives:
            fits = [(-s, k) for s, k, other in scored if other != label and 30 * p <= -100 * s <= 90 * p][:10]
            out += [(i, j, rank + 1, k, p, s) for rank, (s, k) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(4096, 512), (16, 3)])
@pytest.mark.parametrize("kind", ["spread", "near", "ties", "one", "lengths"])
def test_equals_sorting(spark, monkeypatch, kind, sizes):
    monkeypatch.setattr(negatives, "BUCKET", sizes[0])
    monkeypatch.setattr(negatives, "ANCHORS", sizes[1])
    rng = np.random.default_rng(11)
    center = rng.normal(size=(4, 6))
    vectors = {
        "spread": rng.normal(size=(240, 6)),
        "near": center[rng.integers(0, 4, 240)] + 0.2 * rng.normal(size=(240, 6)),
        "ties": rng.integers(0, 2, size=(240, 3)) / 256,
        "one": np.ones((240, 4)),
        "lengths": rng.normal(size=(240, 5)) * np.exp(rng.normal(size=(240, 1)) * 2),
    }[kind].astype(np.float32)
    rows = [(i, int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(vectors)]
    rows += [(None, 1, rows[0][2]), (1000, None, rows[0][2]), (1010, 1, None), (1020, 1, [None] * vectors.shape[1]), (1030, 1, [float("nan")] * vectors.shape[1])]
    rows += [(1040, 1, [1.0, 2.0]), (1050, 1, []), (1060, 2, []), (1070, 1, [1.0, 1.0]), (1080, 2, [0.5, 0.5]), (1090, 1, [0.0] * vectors.shape[1])]
    rows += [rows[20], rows[20], rows[31]]
    df = spark.createDataFrame([(i, label, v, 1, "x") for i, label, v in rows], "vec_id long, label int, embedding array<float>, id int, row string").repartition(3)
    done = negatives.mine(df, F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in done.collect()) == brute(rows, 10)


def test_no_rows_and_no_anchors(spark):
    df = spark.createDataFrame([(1, 1, [1.0]), (2, 2, [0.5])], "vec_id long, label int, embedding array<float>")
    assert negatives.mine(df, F.col("vec_id") == 9).collect() == []
    assert negatives.mine(df.limit(0), F.lit(True)).collect() == []
    assert negatives.mine(df, F.lit(True)).collect() == []


def test_pruning_keeps_all_and_prunes(spark):
    rng = np.random.default_rng(2)
    unit = negatives.units(rng.normal(size=(2000, 8)))
    unit[:50] = negatives.units(unit[50:100] + 0.1 * rng.normal(size=(50, 8)))
    orders = np.argsort(unit, axis=0).astype(np.uint16).T
    seen = 0
    for i in range(50):
        for least in (0.2, 0.8, 0.95, 1.0):
            left = negatives.feasible(unit[i], least, unit, orders)
            assert set(np.flatnonzero(unit @ unit[i] >= least)) <= set(left.tolist())
            seen += len(left) if least == 0.95 else 0
    assert seen < 50 * 2000 / 10
    assert len(negatives.feasible(unit[0], 1.1, unit, orders)) == 0

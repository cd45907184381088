"""SimHash components against comparing all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tierline.llm import simhash


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows: (key, fingerprint). The least key of each row's component, by comparing all pairs."""
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                group[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(rows))]


def flipped(value, rng, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        value ^= 1 << b
    return value


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("chain", [2, 3])
def test_all_near_pairs_meet_in_a_bucket(spark, chain):
    rng = random.Random(chain)
    pairs = []
    for _ in range(150):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        pairs.append((a, b))
    nodes = spark.createDataFrame([(signed(x), 1) for p in pairs for x in p], "fp long, n long").distinct()
    found = simhash.linked(nodes, chain).collect()
    assert {frozenset((r.node, r.root)) for r in found} == {frozenset(map(signed, p)) for p in pairs}


@pytest.mark.parametrize("pairs", [64, 0])
@pytest.mark.parametrize("shape", ["chains", "ball", "far"])
def test_components_equal_all_pairs(spark, monkeypatch, shape, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = random.Random(7)
    values = []
    for _ in range({"chains": 12, "ball": 2, "far": 300}[shape]):
        value = rng.getrandbits(64)
        if shape == "chains":
            for _ in range(25):
                value = flipped(value, rng, 6)
                values.append(value)
        else:
            values += [flipped(value, rng, 8) for _ in range(150 if shape == "ball" else 1)]
    rows = [(i * 7 % 1009, v) for i, v in enumerate(values + values[:20] + [0, 0, (1 << 64) - 1, 1 << 63])]
    nodes = spark.createDataFrame([(k, signed(v)) for k, v in rows], "key long, fp long").groupBy("fp").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    roots = {r.node: r.root for r in simhash.linked(nodes.select("fp", "n")).collect()}
    least = {}
    for k, v in rows:
        root = roots.get(signed(v), signed(v))
        least[root] = min(k, least.get(root, k))
    assert [least[roots.get(signed(v), signed(v))] for _, v in rows] == brute_components(rows)


BASE = " ".join(f"word{i % 37} Thing{i}" for i in range(300))
TEXTS = [None, "", " \t\n", "one", "ONE", "one two\nthree", "one two three four", "One  two\tthree four", "é ü É", BASE, BASE.upper(), BASE.replace("Thing7 ", "other "), BASE + " end"]


def test_fingerprints(spark):
    rng = np.random.default_rng(3)
    random_ = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in rng.integers(1, 60, 40)]
    rows = list(enumerate(TEXTS + random_ + ["long " * 300_000 + "x" * 1_000_000])) + [(None, "one"), (3, "one"), (3, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("key", F.lit(1)).withColumn("start", F.lit(2))
    done = simhash.components(df).select("key", simhash.hexadecimal(F.col("fingerprint")).alias("f"), "component_id")
    prints = [(k, brute_fingerprint(t)) for k, t in rows]
    want = sorted((repr(k), f"{f:016x}", c) for (k, f), c in zip(prints, brute_components(prints)))
    assert sorted((repr(r.key), r.f, r.component_id) for r in done.collect()) == want


def test_bits_are_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 5)
    raw = np.frombuffer(BASE.encode(), np.uint8)
    starts = np.array([0, 40, 40, len(raw)])
    texts = [BASE[:40], "", BASE[40:]]
    assert simhash.majority(*simhash.shingled(raw, starts), 3).tolist() == [brute_fingerprint(t) for t in texts]


def test_no_rows(spark):
    assert simhash.components(spark.createDataFrame([], "doc_id long, text string")).collect() == []

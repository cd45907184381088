"""Mixing against its targets and a plain solver; the pipeline stage by stage."""

import re

import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tierline.llm import mixing
from tierline.llm.queries import TARGETS, op4_mixing

SF = "/root/testdata/sf0.01"


def test_expected_tokens_meet_the_targets(spark):
    rows = op4_mixing(spark, SF).toPandas()
    assert len(rows) == 1000 and (rows.rate >= 0).all()
    p = rows[[f"p_{d}" for d in TARGETS]].to_numpy()
    assert np.allclose(p.sum(1), 1, atol=1e-3)
    reached = (p * (rows.n_tokens * rows.rate).to_numpy()[:, None]).sum(0)
    assert np.allclose(reached / reached.sum(), list(TARGETS.values()), atol=1e-3)
    assert reached.sum() == pytest.approx((p.sum(1) * rows.n_tokens).sum(), rel=1e-3)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(n == len(re.findall(r"[^\x20\x09-\x0D]+", texts[d])) for d, n in zip(rows.doc_id, rows.n_tokens))


@pytest.mark.parametrize("weights", [[0.2, 0.5, 0.3], [0.02, 0.96, 0.02], [0.0, 0.5, 0.5]])
def test_steps_equal_a_plain_solver(spark, weights):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.4, 0.6, 1.0], 60)
    tokens = rng.integers(1, 500, 60).astype(float)
    cells = spark.createDataFrame([(x.tolist(), float(n)) for x, n in zip(p, tokens)], "p array<double>, tokens double")
    steps, targets, reached = mixing.solve(cells, dict(enumerate(weights)), 3, False)
    a = (p * tokens[:, None]).T
    w = np.linalg.inv(a @ (a.T / tokens[:, None]))
    r = np.ones(60)
    for _ in range(20_000):
        r = np.maximum(0, r - p @ (w @ (a @ r - targets)))
    best = lambda x: (a @ x - targets) @ w @ (a @ x - targets)
    own = np.array([x.r for x in cells.select(mixing._rate(steps, mixing.F.col("p"), 0.0).alias("r")).collect()])
    assert (own >= 0).all() and np.allclose(a @ own, reached)
    assert best(own) <= best(r) + 1e-2 * best(np.ones(60)) + 1e-6


def test_odd_rows(spark):
    rows = [(i, "good words and more " * (i % 7 + 1) if i % 3 else "###$$$ BAD BAD ###", 1.0) for i in range(90)]
    rows += [(None, None, 2.0), (91, None, 2.0), (92, "", 2.0), (0, rows[0][1], 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rate double").withColumn("tokens", mixing.F.lit("x"))
    labels = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(60)] + [(None, "a"), (61, None), (1, "z")], "doc_id long, domain string")
    told = mixing.rates(df, labels, {"a": 0.9, "b": 0.1})
    assert told.columns == ["doc_id", "n_tokens", "p_a", "p_b", "rate"] and told.count() == len(rows)
    again = mixing.repeated(df, labels, {"a": 0.9, "b": 0.1}).collect()
    assert {(r.doc_id, r.text) for r in again} == {(i, t) for i, t, _ in rows} and len(again) >= len(rows)
    assert mixing.rates(df.limit(0), labels, {"a": 0.9, "b": 0.1}).collect() == []
    assert {r.rate for r in mixing.rates(df, labels.limit(0), {"a": 1.0}).collect()} == {1.0}


def test_pipeline(spark, tmp_path):
    from test_bagminhash import brute

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(900, None), (901, "12 34 !!"), (902, ""), (903, "the end. mail a@b.cc or call +1 (415) 555-2671 now, is it that?")]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    docs.union(odd).union(docs.limit(3)).write.parquet(str(tmp_path / "in"))
    frame = spark.read.parquet(str(tmp_path / "in"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_dedup", "pii", "mixing", "pieces"]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        stage(spark, frame, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        assert number >= 3 or tuple(frame.columns) == corpus_pipeline.DOCUMENT
        after = sorted((r.doc_id for r in frame.collect()), key=repr)
        if name == "language":
            assert after == sorted((i for i, _ in before if i not in (900, 901, 902)), key=repr)
        elif name == "near_dedup":
            classes = {}
            for (i, _), c in zip(before, brute(before)):
                classes.setdefault(c, []).append(i)
            assert after == sorted((min(v) for v in classes.values()), key=repr)
        elif name == "pii":
            assert after == sorted((i for i, _ in before), key=repr)
            [text] = [r.text for r in frame.filter("doc_id = 903").collect()]
            assert text == "the end. mail [EMAIL] or call [PHONE] now, is it that?"
        elif name == "mixing":
            assert after == sorted((i for i, _ in before), key=repr)
            assert tuple(frame.columns[:6]) == (*corpus_pipeline.DOCUMENT, "copies")
            rows = frame.collect()
            taken = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
            assert sum(n * r.copies for n, r in zip(taken, rows)) == pytest.approx(sum(taken), rel=0.2)
            of = {(r.doc_id, r.text): r.copies for r in rows}
    assert {"ids", "n_tokens", "copies"} <= set(frame.columns) and frame.count() == len(after)
    assert sorted(r.copies for r in frame.collect()) == sorted(of.values())


def test_registered(spark):
    names = [n for n in driver.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_a_rare_domain_reaches_its_target_and_one_without_labels_is_left_out(spark):
    rows = [(i, "good words and more of the same kind " * 2) for i in range(1100)] + [(1100, "###$$$ BAD BAD ### NOT $$$ AT ALL &&& FINE *** |||")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "a" if i < 1100 else "b") for i in range(1101)], "doc_id long, domain string")
    told = mixing.rates(df, labels, {"a": 0.88, "b": 0.02, "never": 0.1}, with_totals=True).toPandas()
    total = told.n_tokens.sum()
    assert (told.p_b * told.n_tokens).sum() / total < 0.02 / 20
    for name, share in (("a", 0.88 / 0.9), ("b", 0.02 / 0.9), ("never", 0.0)):
        reached = (told[f"p_{name}"] * told.n_tokens * told.rate).sum()
        assert reached == pytest.approx(share * total, rel=1e-3, abs=1e-6)
        assert told[f"target_{name}"].nunique() == 1 and told[f"target_{name}"][0] == pytest.approx(share * total)
        assert told[f"reached_{name}"][0] == pytest.approx(reached, rel=1e-6, abs=1e-6)
    assert mixing.repeated(df, labels.filter("domain = 'a'"), {"a": 0.5, "b": 0.5}).count() == len(rows)


def test_copies_bring_the_domains_near_their_targets(spark):
    shares = {"q1t0": 0.6, "q0t0": 0.25, "q1t1": 0.1, "q0t1": 0.05}
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("copies", mixing.F.lit("x")).withColumn("row", mixing.F.lit(1))
    docs = docs.union(docs.limit(5))
    labels = corpus_pipeline.labelled(spark, SF)
    told = mixing.counted(docs, labels, shares).toPandas()
    assert sorted(told.doc_id) == sorted(r.doc_id for r in docs.collect()) and (told.copies >= 0).all()
    assert list(told.columns[:6]) == ["doc_id", "text", "lang", "source", "n_chars", "row"] and (told.row == 1).all()
    assert (told.groupby("doc_id").copies.nunique() == 1).all()
    rates = mixing.rates(docs, labels, shares).toPandas()
    total = rates.n_tokens.sum()
    taken = rates.merge(told[["doc_id", "copies"]].drop_duplicates(), on="doc_id")
    assert ((taken.copies - taken.rate).abs() < 1).all()
    for name, share in shares.items():
        assert told[f"target_{name}"].nunique() == 1
        assert told[f"target_{name}"][0] == pytest.approx(share * total, rel=1e-3)
        assert told[f"reached_{name}"][0] == pytest.approx(share * total, rel=1e-2)
        assert (taken[f"p_{name}"] * taken.n_tokens * taken.copies).sum() == pytest.approx(share * total, rel=0.25)
    odd = spark.createDataFrame([(None, None), (None, ""), (1, None), (1, None)], "doc_id long, text string")
    assert len(mixing.counted(odd, labels, shares).collect()) == 4
    assert mixing.counted(odd.limit(0), labels, shares).collect() == []
    assert {r.copies for r in mixing.counted(odd, labels.limit(0), shares).collect()} == {1}


def test_mixing_decides_what_is_encoded_and_how_often_it_comes_out(spark):
    rows = [(1, "some words", 0), (2, "some words", 1), (3, None, 3)]
    docs = spark.createDataFrame([(i, t, "en", "a", 9, n) for i, t, n in rows], "doc_id long, text string, lang string, source string, n_chars long, copies int")
    coded = corpus_pipeline.tokens(spark, docs, SF)
    told = {r.doc_id: r for r in coded.collect()}
    assert told[1].ids is None and told[1].n_tokens is None and told[1].decoded_sha256 is None
    assert told[2].n_tokens == len(told[2].ids) > 0 and told[3].ids == [] and told[3].decoded_sha256
    out = sorted((r.doc_id, r.copy) for r in corpus_pipeline.taken(coded).collect())
    assert out == [(2, 1), (3, 1), (3, 2), (3, 3)]


def test_features_equal_plain_python_and_split_a_text_once(spark):
    texts = ["", " ", "\n\n", " a", "a ", "a  b\tc\x0bd\x0ce\rf", "A#B", "\U0001f600 \u00c4 A #", "AB CD" * 30, "a a a a a", "&&&|||<>!", "[]^-\\ Z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    told = df.select("text", *[c.alias(n) for n, c in mixing.features(mixing.F.col("text"), (r"(?iu)(?<!\p{L})(?:b)", "")).items()])
    cut = lambda x, bars: sum(x >= b for b in bars)
    for r in told.collect():
        words, chars = re.split(r"[\x20\x09-\x0D]+", r.text), max(len(r.text), 1)
        assert r.tokens == len([w for w in words if w])
        assert r.upper == cut(sum("A" <= c <= "Z" for c in r.text) / chars, (0.1, 0.4))
        assert r.signs == cut(sum(c in "#*$%&|<>!" for c in r.text) / chars, (0.001, 0.01, 0.06))
        assert r.repeats == cut(len(set(words)) / len(words), (0.1, 0.3, 0.5))
        assert r.length == cut(len(words), (12, 60))
        assert (r.marker_0, r.marker_1) == (int(bool(re.search(r"(?<![^\W\d_])b", r.text, re.I))), 0)
    # A lambda keeps Spark from sharing what is below it, and from compiling the projection with its scan.
    assert "lambda" not in told._jdf.queryExecution().optimizedPlan().toString()

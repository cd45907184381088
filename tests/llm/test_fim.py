"""Fill-in-middle against a plain rebuild of the contract."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tierline.llm import fim


def brute(key, text):
    text = text or ""
    told = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(told[i : i + 8], 16) for i in (0, 8, 16, 24)]
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", text, None, None
    if h[3] % 100 < 20:
        return len(tokens), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(tokens), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


TEXTS = [
    None,
    "",
    " ",
    "abc",
    "word two, three!\nfour\r\n$1 and \\2 {3}+ end",
    "Zoë \U0001f600\U0001f600 naïve 漢字 x́  line",
    "has <P> mark",
    "< P> <S <M P> <<S",
    "a<",
    "P>b<S",
    "$1$2$3\\",
    "\n\n\n",
]


def made(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("form", F.lit(0)).withColumn("output", F.lit(1))
    return df


def test_equals_the_contract(spark):
    rows = [(i, t) for i in range(60) for t in TEXTS] + [(None, "some words here"), (7, "abc"), (7, "abc")]
    done = fim.transform(made(spark, rows))
    assert done.columns == ["key", "n", "form", "output", "prefix_chars", "middle_chars"]
    got = sorted((tuple(r) for r in done.collect()), key=repr)
    assert got == sorted(((k, *brute(k, t)) for k, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_texts_come_back(spark):
    rows = [(i, t) for i in range(40) for t in TEXTS]
    done = fim.transform(made(spark, rows)).select("key", fim.restored(F.col("output"), F.col("form")))
    assert sorted(map(tuple, done.collect())) == sorted((i, t or "") for i, t in rows)
    digests = fim.digest(made(spark, rows))
    assert digests.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    whole = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows}
    assert {r.restored_sha256 for r in digests.collect()} == whole


@pytest.mark.parametrize("unit", ["a", "ab ", "é", "\n", "\U0001f600"])
def test_very_long_texts(spark, unit):
    text = unit * 1_000_000
    rows = [(i, text) for i in (1, 2, 3)]
    made_ = fim.transform(made(spark, rows)).select("key", "n", "form", F.md5("output"), "prefix_chars", "middle_chars")
    want = [(k, *brute(k, t)) for k, t in rows]
    want = [(*w[:3], hashlib.md5(w[3].encode()).hexdigest(), *w[4:]) for w in want]
    assert sorted(map(tuple, made_.collect())) == sorted(want)


def test_no_rows_and_no_python(spark):
    none = fim.digest(made(spark, [(1, "a")]).limit(0))
    assert none.collect() == []
    plan = none._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Language filters: exact n-gram counts, held-out accuracy, odd texts."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tierline.llm import language
from tierline.llm.flat import utf8
from tierline.llm.queries import op2_language

SF = "/root/testdata/sf0.01"


def plain_ngrams(text):
    letters = [c.lower() if c.isalpha() and len(c.lower()) == 1 else (c if c.isalpha() else "\0") for c in text]
    around = ["\0", *letters, "\0"]
    return Counter(tuple(around[i - 1 : i + 2]) for i in range(1, len(around) - 1) if around[i] != "\0")


def test_ngrams_equal_a_plain_count():
    texts = [None, "", "a", "Ab c", "é😀ß x", "12 34", "İstanbul", "日本 語"]
    keys, begins = language.ngrams(*utf8(pa.array(texts)))
    for i, text in enumerate(texts):
        own = keys[begins[i] : begins[i + 1]].tolist()
        told = Counter(tuple(chr(k >> s & (1 << 21) - 1) for s in (42, 21, 0)) for k in own)
        assert told == plain_ngrams(text or ""), text


def test_false_positives_are_subtracted():
    inside = np.arange(1, 2000, dtype=np.int64)
    table = np.zeros(4096, np.uint8)
    for places in language._places(inside, 4096):
        table[places] |= 1
    filters = language.Filters(("x",), (table,), np.array([np.mean(table & 1) ** language.PROBES]))
    assert filters.counts(inside, np.array([0, len(inside)]))[0, 0] == len(inside)
    outside = np.arange(10**6, 10**6 + 20000, dtype=np.int64)
    share = filters.counts(outside, np.array([0, len(outside)]))[0, 0] / len(outside)
    assert share == pytest.approx(filters.false[0], abs=0.05) and share > 0.1


def test_held_out_accuracy(spark):
    told = op2_language(spark, SF)
    assert told.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = told.filter("held_out").join(truth, "doc_id").selectExpr("avg(int(lang = lang_pred)) a", "min(score) s", "max(score) t").first()
    assert held.a >= 0.98 and 0 <= held.s <= held.t <= 1
    assert told.count() == truth.count()


def test_odd_rows(spark):
    learned = [("the cat and the dog", "en")] * 3 + [("le chat et le chien", "fr"), (None, "fr"), ("lost", None)]
    filters = language.fit(spark.createDataFrame(learned, "text string, lang string"))
    rows = [(None, 1), ("", 2), ("12 !? 😀", 3), ("the dog", 4), ("le chien", 5), ("zzz", 6), ("the cat " * 20000, 7), ("the dog", 4)]
    df = spark.createDataFrame(rows, "text string, score int").withColumn("lang", language.F.lit("fr"))
    told = language.identify(df, filters)
    assert told.columns == ["text", "lang", "lang_pred", "score"]
    assert [r.lang_pred for r in told.collect()] == ["und", "und", "und", "en", "fr", "en", "en", "en"]
    assert language.identify(df.limit(0), filters).collect() == []
    nothing = language.fit(df.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(df, nothing).collect()} == {("und", 0.0)}


def test_more_languages_than_bits_of_a_word(spark):
    alphabet = [chr(0x4E00 + 10 * i) + chr(0x4E03 + 10 * i) for i in range(70)]
    df = spark.createDataFrame([(a * 5, f"l{i:02d}") for i, a in enumerate(alphabet)], "text string, lang string")
    told = language.identify(df, language.fit(df)).collect()
    assert all(r.lang == r.lang_pred for r in told)

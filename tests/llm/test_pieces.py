"""Ids and decoded texts against the library itself."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tierline.llm import pieces  # noqa: E402
from tierline.llm.flat import utf8  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "▁", " ▁ x", " " * 3000, "a" * 4000, "ab" * 2000, "日本語" * 800, "\n\t\x00", "<s></s><unk><0x41>", "﻿é😀ﷺ", "x  y   z    "]


def random_texts(count):
    rng = random.Random(7)
    letters = "abcdef  the ing▁ \n\t日本語éß😀ﷺ\x00.,12345ABC"
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 150))) for _ in range(count)]
    return texts + ["".join(chr(rng.randint(1, 0x2FFF)) for _ in range(40)) for _ in range(count // 4)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("rounds", [pieces.ROUNDS, 1])
def test_ids_equal_the_library(library, monkeypatch, rounds):
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    texts = ODD + random_texts(1200 if rounds > 1 else 100)
    ids, starts = pieces.pieces(MODEL).encode(*utf8(pa.array(texts)))
    for i, wanted in enumerate(library.encode([t or "" for t in texts])):
        assert ids[starts[i] : starts[i + 1]].tolist() == wanted, texts[i]


def test_any_ids_decode_as_in_the_library(library):
    rng = random.Random(3)
    lists = [[rng.randrange(library.vocab_size()) for _ in range(rng.randint(0, 9))] for _ in range(400)]
    lists += [[3 + b for b in rng.choices(range(256), k=rng.randint(1, 6))] + [rng.randrange(259, 32000)] for _ in range(400)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    raw, ends = pieces.pieces(MODEL).decode(np.array([i for x in lists for i in x]), starts)
    for i, ids in enumerate(lists):
        assert raw[ends[i] : ends[i + 1]].tobytes().decode() == library.decode(ids), ids


def test_query_digests(spark, library):
    texts = ODD + random_texts(40)
    df = spark.createDataFrame([(i % 50, t, "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded int").repartition(5)
    rows = sorted(tuple(r) for r in pieces.digest(df, MODEL).collect())
    wanted = []
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        wanted.append((i % 50, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert rows == sorted(wanted)
    assert pieces.digest(df.limit(0), MODEL).collect() == []
    kept = pieces.encode(df, MODEL)
    assert kept.columns == ["doc_id", "text", "decoded", "ids"] and kept.count() == len(texts)

"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are labels; everything else is unlabelled text,
toxic documents among it. With the class prior p the risk of a classifier is

    p * R(positives as positive) + max(0, R(unlabelled as negative) - p * R(positives as negative))

where the second term estimates the risk on the negatives, and a negative value
of it only means overfitting: then the step goes back on that term. The
classifier is linear in the presence of words, trained with numpy on a bounded
sample; every document is scored on its whole text in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.flat import blocks, code_points, hashed
from tierline.llm.language import folded
from tierline.workspace import new_dir

# The expected sizes of the samples that fitting reads.
POSITIVES = 6_000
UNLABELLED = 24_000
# A word is a feature if at least this share of the positives, and this many, have it.
MIN_SHARE = 0.004
MIN_POSITIVES = 3
# Standard errors by which its share of the positives must exceed its share of the unlabelled.
SURE = 4.0
# Beginnings of words, in letters: endings vary in most languages.
BEGINNINGS = (4, 5, 6)
# Words that a task gathers before it sums them.
COUNTED = 2_000_000
STEPS = 800
RATE = 0.1
DECAY = 1e-5


def letter_words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of letters, case folded, and of its beginnings; and the text each is in."""
    points, begins = code_points(raw, starts)
    letters = folded()[points]
    inner = letters > 0
    edge = np.zeros(len(points) + 1, bool)
    edge[begins] = True
    opens = inner.copy()
    opens[1:] &= ~inner[:-1] | edge[1:-1]
    closes = inner.copy()
    closes[:-1] &= ~inner[1:] | edge[1:-1]
    first = np.flatnonzero(opens)
    last = np.flatnonzero(closes) + 1
    text, sizes = np.searchsorted(begins, first, "right") - 1, last - first
    keys, owners = [hashed(letters, first, sizes)], [text]
    for k in BEGINNINGS:
        longer = sizes > k
        keys.append(~hashed(letters, first[longer], np.full(int(longer.sum()), k)))
        owners.append(text[longer])
    return np.concatenate(keys), np.concatenate(owners)


def present(raw: np.ndarray, starts: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each text (all, or places among sorted ``known`` ones), in the order of texts."""
    words, text = letter_words(raw, starts)
    if known is not None:
        at = np.searchsorted(known, words)
        at[at == len(known)] = 0
        hit = known[at] == words if len(known) else np.zeros(len(words), bool)
        words, text = at[hit].astype(np.uint64), text[hit]
    order = np.lexsort((words, text))
    words, text = words[order], text[order]
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
    return words[fresh], text[fresh]


def _words(df: DataFrame, known: np.ndarray | None) -> DataFrame:
    """``words``: the distinct words of each text, or their places among known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, starts in blocks(batches, "text"):
            words, text = present(raw, starts, known)
            places = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(places), pa.array(words.view(np.int64)))], ["words"])

    return df.select("text").mapInArrow(run, "words array<long>")


def _counts(df: DataFrame, known: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Words (or places) that at least so many texts have, in order, and how many have them.

    Both are summed per task before they are shuffled; without known words that is at most what the sample's texts hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def summed() -> None:
            nonlocal words, n
            words, at = np.unique(np.concatenate([words, *held]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, np.ones(len(at) - len(n), np.int64)]), len(words)).astype(np.int64)
            held.clear()

        for _, raw, starts in blocks(batches, "text"):
            held.append(present(raw, starts, known)[0])
            if sum(map(len, held)) > COUNTED:
                summed()
        summed()
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    each = df.select("text").mapInArrow(run, "word long, n long")
    table = each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= float(least)).toArrow()
    words, n = np.asarray(table["word"]).view(np.uint64), np.asarray(table["n"])
    order = np.argsort(words)
    return words[order], n[order]


def _collected(df: DataFrame, known: np.ndarray) -> list[np.ndarray]:
    """Places of the known words of each text of a sample, on the driver."""
    lists = _words(df, known).toArrow()["words"].combine_chunks()
    sizes = np.asarray(lists.value_lengths(), np.int64)
    docs = np.split(np.asarray(lists.flatten(), np.int64), np.cumsum(sizes)[:-1]) if len(sizes) else []
    # The order in which rows arrive is not fixed; a sorted one makes training repeatable.
    return sorted(docs, key=lambda x: (len(x), x.tobytes()))


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def _sample(df: DataFrame, wanted: int, total: int) -> DataFrame:
    """Of ``total`` rows those whose key has a certain hash, about as many as wanted."""
    if total <= wanted:
        return df
    return df.filter(F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * wanted / total))


def fit(df: DataFrame, labels: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the rows of ``df``; ``labels`` has the key and 1 for confirmed toxic documents, 0 for confirmed others.

    The zeros only serve to estimate the class prior. Rows without a key or text teach nothing. Without any confirmed
    toxic document the model scores everything 0.
    """
    rows = df.select(F.col(f"`{key_col}`").alias("key"), F.col(f"`{text_col}`").alias("text")).filter("key is not null and text is not null")
    told = labels.select(F.col(f"`{key_col}`").alias("key"), F.col(f"`{label_col}`").alias("y")).filter("key is not null and y is not null")
    told = told.groupBy("key").agg(F.max("y").alias("y"))
    keyed = rows.groupBy("key").agg(F.count("*").alias("c")).join(told, "key")
    known = keyed.agg(F.count("*").alias("n"), F.sum("y").alias("p"), F.sum(F.when(F.col("y") == 1, F.col("c"))).alias("c")).first()
    if not known.p:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf, 0.0)
    prior = min(0.5, known.p / known.n)
    spark, path = df.sparkSession, new_dir(df.sparkSession, "toxic")
    # Keys are chosen before a text is touched: about POSITIVES of them, which Spark sends to the texts by their size.
    _sample(keyed.filter("y = 1").select("key"), POSITIVES, known.c).write.parquet(f"{path}/keys")
    chosen = spark.read.parquet(f"{path}/keys")
    for name, sample in (("p", rows.join(chosen, "key", "left_semi")), ("u", _sample(rows, UNLABELLED, rows.count()))):
        sample.select("text").write.parquet(f"{path}/{name}")
    positive, unlabelled = (spark.read.parquet(f"{path}/{name}") for name in ("p", "u"))
    n_p, n_u = positive.count(), max(unlabelled.count(), 1)
    words, n = _counts(positive, None, max(MIN_POSITIVES if n_p > 20 else 1, MIN_SHARE * n_p))
    share, usual = n / max(n_p, 1), np.zeros(len(words))
    place, n = _counts(unlabelled, words, 1)
    usual[place.astype(np.int64)] = n / n_u
    # A word that only toxic documents have is 1 / prior times as common among them; half of that way is asked for.
    marked = (share - usual > SURE * np.sqrt(usual * (1 - usual) / max(n_p, 1))) & (share * np.sqrt(prior) > usual)
    words = words[marked]
    positive, unlabelled = _collected(positive, words), _collected(unlabelled, words)
    weights, bias = trained(positive, unlabelled, len(words), prior)
    return Model(words, weights, bias, prior)


def trained(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk with the logistic loss."""
    sides = []
    for docs in (positive, unlabelled):
        at = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        sides.append((at, np.concatenate([*docs, np.zeros(0, np.int64)]).astype(np.int64), max(len(docs), 1)))
    theta, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    theta[size] = np.log(prior / (1 - prior))

    def scores(side):
        at, word, n = side
        return theta[size] + np.bincount(at, theta[word], n)

    def pulled(side, slope):
        at, word, n = side
        return np.append(np.bincount(word, slope[at], size), slope.sum()) / n

    softplus = lambda z: np.logaddexp(0, z)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, STEPS + 1):
        zp, zu = scores(sides[0]), scores(sides[1])
        negative = softplus(zu).mean() - prior * softplus(zp).mean()
        as_negative = pulled(sides[1], sigmoid(zu)) - prior * pulled(sides[0], sigmoid(zp))
        as_positive = prior * pulled(sides[0], sigmoid(zp) - 1)
        slope = as_positive + as_negative if negative >= 0 else -as_negative
        slope[:size] += DECAY * theta[:size]
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[size])


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``score``, the estimated probability that the text is toxic. A null text is an empty one, which has a score too."""
    base = df.drop("score")
    schema = T.StructType([*base.schema, T.StructField("score", T.DoubleType())])
    words, weights, bias = model.words, model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, starts in blocks(batches, text_col):
            at, text = present(raw, starts, words)
            z = bias + np.bincount(text, weights[at.astype(np.int64)], part.num_rows)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.exp(-np.logaddexp(0, -z)))], schema.names)

    return base.mapInArrow(run, schema)

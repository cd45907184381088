"""Language identification with bit-sliced Bloom filters of character n-grams.

One table of bit masks holds a Bloom filter per language, bit by bit side by
side: looking an n-gram up at its few places and taking what all masks have in
common gives every language that contains it at once. Per document the bits are
counted per language and corrected for the filter's false positives; the
language with most of the document's n-grams is the answer.

An n-gram belongs to a language if it makes up at least ``MIN_RATE`` of the
language's n-grams and at least ``MIN_SHARE`` of the rate at which the language
that uses it most does. So a language has at most 1 / MIN_RATE n-grams, however
large the corpus, and the table that tasks share has a size known beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.flat import blocks, code_points, mixed
from tierline.workspace import checkpointed

UNDETERMINED = "und"
MIN_RATE = 2e-5
MIN_SHARE = 0.5
PROBES = 4
PLACES_PER_NGRAM = 12
HELD = 400_000
POINT_BITS = 21


@cache
def folded() -> np.ndarray:
    """Code point -> code point of the small letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            small = c.lower()
            table[point] = ord(small) if len(small) == 1 else point
    return table


def ngrams(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter trigrams of all texts, and where each text starts among them.

    A trigram has a letter in the middle; what is no letter, or the border of a text, is one sign at its side.
    """
    points, begins = code_points(raw, starts)
    letters = folded()[points]
    left, right = np.zeros_like(letters), np.zeros_like(letters)
    left[1:], right[:-1] = letters[:-1], letters[1:]
    inner = begins[(begins > 0) & (begins < len(points))]
    left[inner], right[inner - 1] = 0, 0
    middle = letters > 0
    keys = (left << (2 * POINT_BITS) | letters << POINT_BITS | right)[middle]
    return keys, np.concatenate([[0], np.cumsum(middle)])[begins]


@dataclass(frozen=True)
class Filters:
    """``masks[w][place]`` has a bit for each language of the w-th 64; ``false`` is each one's false-positive rate."""

    languages: tuple[str, ...]
    masks: tuple[np.ndarray, ...]
    false: np.ndarray

    def counts(self, keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """n-grams of each text (rows) that each language contains."""
        out = np.zeros((len(begins) - 1, len(self.languages)), np.int64)
        if not len(keys) or not self.languages:
            return out
        places = _places(keys, len(self.masks[0]))
        for word, masks in enumerate(self.masks):
            common = masks[places[0]]
            for more in places[1:]:
                common = common & masks[more]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                has = np.concatenate([[0], np.cumsum(common >> masks.dtype.type(bit) & masks.dtype.type(1), dtype=np.int64)])
                out[:, 64 * word + bit] = np.diff(has[begins])
        return out


def _places(keys: np.ndarray, size: int) -> list[np.ndarray]:
    spread = mixed(keys.astype(np.uint64))
    step = spread >> np.uint64(32) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((spread + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64) for i in range(PROBES)]


def _counts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, key, n): how often each language has each n-gram; summed per task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[np.ndarray] = [np.zeros((3, 0), np.int64)]

        def summed() -> np.ndarray:
            lang, key, n = np.concatenate(held, axis=1)
            order = np.lexsort((key, lang))
            lang, key, n = lang[order], key[order], n[order]
            first = np.flatnonzero((np.diff(lang, prepend=-1) != 0) | (np.diff(key, prepend=-1) != 0))
            return np.stack([lang[first], key[first], np.add.reduceat(n, first) if len(first) else n])

        def batch(rows: np.ndarray) -> pa.RecordBatch:
            texts = pa.array(list(names) or [""])
            return pa.RecordBatch.from_arrays([texts.take(pa.array(rows[0])), pa.array(rows[1]), pa.array(rows[2])], ["lang", "key", "n"])

        for part, raw, starts in blocks(batches, "text"):
            keys, begins = ngrams(raw, starts)
            codes = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], np.int64)
            per_key = np.repeat(codes, np.diff(begins))
            for code in np.unique(codes):
                found, n = np.unique(keys[per_key == code], return_counts=True)
                held.append(np.stack([np.full(len(found), code), found, n]))
            if sum(x.shape[1] for x in held) > 4 * HELD:
                held[:] = [summed()]
                if held[0].shape[1] > HELD:
                    yield batch(held.pop())
                    held.append(np.zeros((3, 0), np.int64))
        yield batch(summed())

    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    return rows.filter("lang is not null").mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from all rows with a language.

    What the driver gets is one row per language and at most PLACES_PER_NGRAM * languages / MIN_RATE masks.
    """
    counts = checkpointed(_counts(df, text_col, lang_col))
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect() if r.n}
    languages = tuple(sorted(totals, key=lambda x: (-totals[x], x)))
    if not languages:
        return Filters((), (), np.zeros(0))
    # The best rate of an n-gram, then the languages near it; the rows of an n-gram are as many as languages at most.
    rate = F.col("n") / F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(float(totals[k])))])[F.col("lang")]
    rated = counts.withColumn("rate", rate)
    top = rated.groupBy("key").agg(F.max("rate").alias("top"))
    near = rated.filter(F.col("rate") >= MIN_RATE).join(top, "key").filter(F.col("rate") >= MIN_SHARE * F.col("top"))
    code = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.lit(i))])[F.col("lang")]
    chosen = near.select("key", code.alias("code")).toArrow()
    keys, codes = np.asarray(chosen["key"]), np.asarray(chosen["code"])
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(np.unique(keys))) * PLACES_PER_NGRAM))))
    masks, false = [], np.zeros(len(languages))
    width = np.uint8 if len(languages) <= 8 else np.uint64
    for word in range(0, len(languages), 64):
        table = np.zeros(size, width)
        for code in range(word, min(word + 64, len(languages))):
            for places in _places(keys[codes == code], size):
                table[places] |= width(1 << (code - word))
            false[code] = float(np.mean(table >> width(code - word) & width(1))) ** PROBES
        masks.append(table)
    return Filters(languages, tuple(masks), false)


def identify(df: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the share of the text's n-grams that the language has.

    A text without letters, an empty or a null one is ``und`` with score 0. Equal counts go to the language that was
    learned from more n-grams. Without any language to learn from, everything is ``und``. Rows and other columns stay.
    """
    base = df.drop("lang_pred", "score")
    schema = T.StructType([*base.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = pa.array([*filters.languages, UNDETERMINED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, starts in blocks(batches, text_col):
            keys, begins = ngrams(raw, starts)
            n = np.diff(begins)
            best = np.full(len(n), len(filters.languages))
            score = np.zeros(len(n))
            if filters.languages:
                hits = filters.counts(keys, begins)
                sure = np.maximum((hits - n[:, None] * filters.false) / (1 - filters.false), 0)
                best = np.where(n > 0, sure.argmax(1), best)
                score = np.where(n > 0, sure.max(1) / np.maximum(n, 1), 0.0)
            columns = [names.take(pa.array(best)), pa.array(np.minimum(score, 1.0))]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, "lang_pred", "score"])

    return base.mapInArrow(run, schema)

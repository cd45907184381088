"""Near-duplicate documents by SimHash, found with a pigeonring filter.

The 64 bits of a fingerprint are five segments on a ring. If two fingerprints
differ in at most four bits, then from some segment on every chain of l
segments differs in at most l * 4/5 bits: none in the first, one in the first
two, two in three, three in four. A bucket is a start together with the values
of the first ``CHAIN`` segments. A fingerprint is at home in five buckets and
visits those whose later segments it reaches within the budgets, so every pair
that may link meets where one is at home. The budgets of the longer chains are
tested when they meet, and the full distance last.

Equal fingerprints are one node. The node of most rows that is at home in a
bucket leads it and is compared with all who are there. What is then of one
class needs no further comparison, so only pairs across the classes of a bucket
are left. Where those are many, more leaders are compared first. No bucket is
collected, and no pair within a class is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.bagminhash import stars
from tierline.llm.flat import blocks, counted, spread, words
from tierline.workspace import checkpointed

# The shingles, their hash, and the distance of a link.
WORDS = 4
SEED = 42
BITS = 64
DIFFERING = 4

# Where the segments start, from the highest bit.
CUTS = (0, 13, 26, 39, 52, 64)
SEGMENTS = len(CUTS) - 1
# Segments whose values name a bucket. Two make 26 bits and 70 rows for a fingerprint, three 39 bits and 1,370:
# worth it from some hundred million different fingerprints on.
CHAIN = 2
# Hashes whose bits are counted at once.
COUNTED = 1 << 16
# Pairs across classes for each member of a bucket, beyond which further leaders are tried first.
PAIRS = 64


def shingled(raw: np.ndarray, starts: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of lower-cased words, and which text each is of; a text of fewer words is one shingle."""
    first, last = words(raw, starts)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    small = raw + np.uint8(32) * ((raw >= 65) & (raw <= 90))
    length = last - first
    # All words one after the other with single spaces, so that a shingle is a slice.
    begin = np.cumsum(length + 1) - length - 1
    joined = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    joined[spread(begin, length)] = small[spread(first, length)]
    text = counted(starts, first)
    n = np.bincount(text, minlength=len(starts) - 1)
    place = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
    of_text = np.repeat(n, n)
    heads = np.flatnonzero((place + size <= of_text) | (place == 0))
    ends = heads + np.minimum(of_text[heads], size) - 1
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    spans = zip(begin[heads].tolist(), (begin[ends] + length[ends]).tolist())
    return np.fromiter((digest(view[a:b], SEED) for a, b in spans), np.uint64, len(heads)), text[heads]


def majority(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """For each text the bits that over half of its hashes have; zero without hashes. Texts are in order."""
    ones = np.zeros((texts, BITS), np.int64)
    for at in range(0, len(hashes), COUNTED):
        own = text[at : at + COUNTED]
        bits = np.unpackbits(hashes[at : at + COUNTED].astype(">u8").view(np.uint8)).reshape(-1, BITS)
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    total = np.bincount(text, minlength=texts)
    return np.packbits(ones * 2 > total[:, None], axis=1).view(">u8").reshape(texts).astype(np.uint64)


def fingerprints(df: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, fp) of every row; the fingerprint is a long. A text without words, or null, has zero."""
    rows = df.select(F.col(f"`{key_col}`").alias("key"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, starts in blocks(batches, "text"):
            told = majority(*shingled(raw, starts), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(told.view(np.int64))], ["key", "fp"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _mask(start: int, chain: int) -> int:
    """The bits of so many segments of the ring from one on."""
    return sum(((1 << CUTS[i + 1] - CUTS[i]) - 1) << BITS - CUTS[i + 1] for i in (k % SEGMENTS for k in range(start, start + chain)))


def _reach(start: int, chain: int, differing: int = DIFFERING) -> list[int]:
    """All differences in a chain that keep the budget of each of its beginnings."""
    out = [0]
    for k in range(chain):
        own = [i for i in range(BITS) if _mask((start + k) % SEGMENTS, 1) >> i & 1]
        budget = (k + 1) * differing // SEGMENTS
        changes = [sum(1 << i for i in c) for n in range(budget + 1) for c in combinations(own, n)]
        out = [x | c for x in out for c in changes if (x | c).bit_count() <= budget]
    return out


def _buckets(fp: Column, chain: int, visits: bool) -> Column:
    """The buckets (start, value) of a fingerprint: those where it is at home, or all that it visits, home included."""


    def from_start(start: int) -> Column:
        own = fp.bitwiseAND(F.lit(_signed(_mask(start, chain))))
        changes = F.array(*[F.lit(_signed(c)) for c in (_reach(start, chain) if visits else [0])])
        return F.transform(changes, lambda change: F.struct(F.lit(start).alias("start"), own.bitwiseXOR(change).alias("value")))

    return F.concat(*map(from_start, range(SEGMENTS)))


def _linked(a: Column, b: Column, start: Column) -> Column:
    """The budgets of the longer chains from the bucket's start, then the full distance."""
    apart = a.bitwiseXOR(b)
    passes = F.lit(True)
    for chain in range(CHAIN + 1, SEGMENTS):
        masks = F.array(*[F.lit(_signed(_mask(s, chain))) for s in range(SEGMENTS)])
        passes &= F.bit_count(apart.bitwiseAND(F.get(masks, start))) <= chain * DIFFERING // SEGMENTS
    return passes & (F.bit_count(apart) <= DIFFERING)


BUCKET = ["start", "value"]


def _members(nodes: DataFrame, chain: int) -> DataFrame:
    """(start, value, fp, home, n, leader) of all buckets where somebody is at home and somebody else is too."""
    home = nodes.select("fp", "n", F.inline(_buckets(F.col("fp"), chain, visits=False)))
    first = F.max(F.struct("n", "fp"))
    led = home.groupBy(*BUCKET).agg(first["fp"].alias("leader"), F.count("*").alias("homes"))
    there = nodes.select("fp", "n", F.inline(_buckets(F.col("fp"), chain, visits=True)))
    masks = F.array(*[F.lit(_signed(_mask(s, chain))) for s in range(SEGMENTS)])
    at_home = F.col("fp").bitwiseAND(F.get(masks, F.col("start"))) == F.col("value")
    met = there.join(led, BUCKET).filter("homes > 1 OR fp <> leader")
    return met.select(*BUCKET, "fp", at_home.alias("home"), "n", "leader")


def _across(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of buckets of several classes, with their class, and ``of``, the class of most members of the bucket."""
    own = members.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    sizes = own.groupBy(*BUCKET, "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy(*BUCKET).agg(F.max(F.struct("c", "root"))["root"].alias("of"), F.count("*").alias("classes"))
    return own.join(main.filter("classes > 1"), BUCKET).select(*BUCKET, "fp", "home", "n", "root", "of")


def _work(open_: DataFrame) -> tuple[int, int]:
    """Members of open buckets, and the pairs across the main class and the others that are to be tested."""
    apart = F.col("root") != F.col("of")
    per = open_.groupBy(*BUCKET).agg(
        F.count("*").alias("m"), F.count_if(apart).alias("r"), F.count_if(apart & F.col("home")).alias("rh"), F.count_if(~apart & F.col("home")).alias("oh")
    )
    told = per.agg(F.sum("m").alias("m"), F.sum(F.col("rh") * F.col("m") + F.col("oh") * F.col("r")).cast("decimal(38,0)").alias("w")).first()
    return told.m or 0, int(told.w or 0)


def _named(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*BUCKET, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def _met(homes: DataFrame, others: DataFrame) -> DataFrame:
    """Links (a, b) between members at home in a bucket and others of other classes there."""
    one, two = _named(homes, "h", "fp", "root"), _named(others, "o", "fp", "root")
    met = one.join(two, BUCKET).filter((F.col("h_root") != F.col("o_root")) & _linked(F.col("h_fp"), F.col("o_fp"), F.col("start")))
    return met.select(F.col("h_fp").alias("a"), F.col("o_fp").alias("b")).distinct()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    return stars(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def linked(nodes: DataFrame, chain: int = CHAIN) -> DataFrame:
    """(node, root) of all fingerprints (fp, n) that are linked to another, except the roots, which are the least of their component."""
    members = checkpointed(_members(nodes, chain))
    first = members.filter((F.col("fp") != F.col("leader")) & _linked(F.col("fp"), F.col("leader"), F.col("start")))
    roots = stars(first.select(F.col("fp").alias("a"), F.col("leader").alias("b")))
    turn, before = 0, None
    while True:
        open_ = checkpointed(_across(members, roots))
        rows, work = _work(open_)
        if work <= PAIRS * rows or before is not None and work > before / 2:
            break
        # One member outside the main class, another in each turn, meets all of its bucket.
        apart = open_.filter("home AND root <> of")
        chosen = apart.groupBy(*BUCKET).agg(F.min(F.struct(F.xxhash64("fp", F.lit(turn)), "fp", "root")).alias("x"))
        roots = _joined(roots, checkpointed(_met(chosen.select(*BUCKET, "x.fp", "x.root"), open_)))
        turn, before = turn + 1, work
    rest = _met(open_.filter("home AND root <> of"), open_).union(_met(open_.filter("home AND root = of"), open_.filter("root <> of")))
    more = checkpointed(rest)
    return roots if more.isEmpty() else _joined(roots, more)


def components(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """One row per row of ``df``: ``key``, ``fingerprint`` (a long) and ``component_id``, the least key that links reach.

    Other columns are left out, so none can clash. Rows link if their fingerprints differ in at most four bits. A null
    text is an empty one; texts without words have the fingerprint zero and link like others. Rows of equal keys are rows
    of their own. Null keys are never the least; a component of null keys only has a null id. A very long text is hashed
    shingle by shingle and its bits are counted in pieces.
    """
    rows = checkpointed(fingerprints(df, key_col, text_col))
    nodes = checkpointed(rows.groupBy("fp").agg(F.min("key").alias("key"), F.count("*").alias("n")))
    roots = linked(nodes.select("fp", "n"), chain)
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    told = checkpointed(placed.join(least, "root").select("fp", "component_id"))
    return rows.join(told, "fp").select("key", F.col("fp").alias("fingerprint"), "component_id")


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")

"""Near-duplicate documents: BagMinHash signatures, bands, exact verification, classes.

A document is the multiset of its five-word shingles. BagMinHash sees a shingle
that occurs w times as a Poisson process of rate w whose points land in the
registers of the signature; a register keeps its earliest point, so two
documents agree in a register with the probability of their weighted Jaccard
similarity. The weights 1, 2, 3 ... are discretised as a hierarchy of ranges
(0,1], (1,2], (2,4], (4,8] ... with a process each; a point of a range that the
weight only partly covers says at which weight it begins. Points are generated
in the order of time and no further than the time by which all registers are
full, which needs about m log m points, not m times the number of shingles.

Equal texts are one node from the start. Nodes that share a band meet in a
bucket. The most connected node of a bucket leads it and is compared with the
others by exact multiset overlap; who is then in one class needs no further
comparison. In buckets whose members are not all of one class, the pairs across
classes are tested by size and by the agreement of all registers inside the
join, and the few that may be similar are compared. No group is collected, and
no pair inside a class or of plainly different texts is made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.flat import BLOCK, blocks, counted, hashed, mixed, numbered, utf8, words
from tierline.workspace import checkpointed, new_dir

WORDS = 5
SIMILARITY = 0.8
# A pair at similarity 0.8 misses all of 25 bands of 5 with probability 5e-5.
BANDS = 25
ROWS = 5
# Members of buckets that are not of one class get this many registers more to be told
# apart by, two bits each.
WIDE = 1024
PLANES = 2
# Registers that a task holds at once; short texts are many to a block.
REGISTERS = 1 << 20

_OF_WORD = numbered(WORDS, 3)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: np.ndarray, starts: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of ``size`` words, and the text it is in; a shorter text is one shingle."""
    first, last = words(raw, starts)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    each = hashed(raw, first, last - first)
    text = counted(starts, first)
    n = np.bincount(text, minlength=len(starts) - 1)
    ends = np.cumsum(n)
    left = np.repeat(ends, n) - np.arange(len(each))
    with np.errstate(over="ignore"):
        total = np.zeros(len(each), np.uint64)
        for k in range(size):
            part = np.zeros(len(each), np.uint64)
            part[: len(each) - k] = each[k:]
            total += np.where(left > k, part * _OF_WORD[k % WORDS], np.uint64(0))
        total = mixed(total + np.minimum(left, size).astype(np.uint64))
    keep = (left >= size) | (np.repeat(n, n) < size) & (left == np.repeat(n, n))
    return total[keep], text[keep]


def bag(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in the order of texts: key, text, count."""
    with np.errstate(over="ignore"):
        own = mixed(keys + mixed(text.astype(np.uint64) * _GOLD))
    _, sample, n = np.unique(own, return_index=True, return_counts=True)
    order = np.argsort(text[sample], kind="stable")
    return keys[sample][order], text[sample][order], n[order]


def signatures(keys: np.ndarray, text: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """BagMinHash registers (times of points) of every text; infinite where a text has no shingle."""
    out = np.full(texts * m, np.inf)
    if not len(keys):
        return out.reshape(texts, m)
    ranges = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    at = np.repeat(np.arange(len(keys)), ranges)
    level = np.arange(len(at)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
    width = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0))
    low = np.where(level == 0, 0, width)
    owner, most = text[at], weight[at]
    with np.errstate(over="ignore"):
        seed = mixed(keys[at] + level.astype(np.uint64) * _GOLD)
    time = np.zeros(len(at))
    drawn = np.zeros(len(at), np.uint64)
    turn = np.zeros(len(at), np.uint64)

    def advance(of: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            turn[of] += np.uint64(1)
            h = mixed(seed[of] + turn[of] * _GOLD)
        time[of] -= np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[of]
        drawn[of] = mixed(h ^ _GOLD)

    advance(np.arange(len(at)))
    total = np.bincount(text, weight, texts)
    limit = m * (np.log(m) + 3) / np.maximum(total, 1)
    due = np.arange(len(at))
    while True:
        due = due[time[due] <= limit[owner[due]]]
        if not len(due):
            short = np.zeros(texts, bool)
            short[text] = True
            short &= np.isinf(out.reshape(texts, m)).any(1)
            if not short.any():
                return out.reshape(texts, m)
            limit[short] *= 2
            due = np.flatnonzero(short[owner])
            continue
        h = drawn[due]
        where = low[due] + (((h & np.uint64(0xFFFFFFFF)) * width[due].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        counts = where < most[due]
        register = (((h >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(out, (owner[due] * m + register)[counts], time[due][counts])
        advance(due)


def banded(registers: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit hash per band; the band's number is part of it."""
    texts, m = registers.shape
    bits = mixed(registers.view(np.uint64))
    with np.errstate(over="ignore"):
        weighted = bits * numbered(m, 4)
        total = weighted.reshape(texts, m // rows, rows).sum(2, dtype=np.uint64)
        return mixed(total + np.arange(m // rows, dtype=np.uint64) * _GOLD).view(np.int64)


def briefed(registers: np.ndarray) -> np.ndarray:
    """The low bits of each register, as bit planes of a long for every 64 registers."""
    texts, m = registers.shape
    bits = mixed(registers.view(np.uint64)).reshape(texts, m // 64, 1, 64) >> np.arange(PLANES, dtype=np.uint64)[:, None]
    planes = (bits & np.uint64(1)) << np.arange(64, dtype=np.uint64)
    return planes.sum(3, dtype=np.uint64).reshape(texts, -1).view(np.int64)


def _lists(values: np.ndarray, has: np.ndarray) -> pa.Array:
    places = np.concatenate([[0], np.cumsum(has * values.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values[has].reshape(-1)))


def with_signature(df: DataFrame, text_col: str, name: str, m: int, form) -> DataFrame:
    """Adds ``total``, the number of shingles, and an array of longs made from m registers; empty for a text without words."""
    added = [T.StructField("total", T.LongType()), T.StructField(name, T.ArrayType(T.LongType()))]
    schema = T.StructType([*df.schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, starts in blocks(batches, text_col, BLOCK // 2, max(1, REGISTERS // m)):
            keys, text, n = bag(*shingles(raw, starts))
            total = np.bincount(text, n, part.num_rows).astype(np.int64)
            values = form(signatures(keys, text, n, part.num_rows, m))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(total), _lists(values, total > 0)], schema.names)

    return df.mapInArrow(run, schema)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], pairs: int) -> np.ndarray:
    """Weighted Jaccard similarity of the bags of each pair of texts."""

    def bags(raw: np.ndarray, starts: np.ndarray):
        keys, text = shingles(raw, starts)
        with np.errstate(over="ignore"):
            own = mixed(keys + mixed(text.astype(np.uint64) * _GOLD))
        values, sample, n = np.unique(own, return_index=True, return_counts=True)
        return values, text[sample], n, np.bincount(text, minlength=pairs)

    a_keys, a_text, a_n, a_total = bags(*a)
    b_keys, _, b_n, b_total = bags(*b)
    _, i, j = np.intersect1d(a_keys, b_keys, assume_unique=True, return_indices=True)
    shared = np.bincount(a_text[i], np.minimum(a_n[i], b_n[j]), pairs)
    return shared / np.maximum(a_total + b_total - shared, 1)


def verified(pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b, text_a, text_b) whose bags overlap enough, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part, raw, starts in blocks(iter([whole]), "text_a", BLOCK // 2):
                other, begins = utf8(part.column("text_b"))
                # The other text may be longer; a pair far apart in size cannot be similar, so neither is much more.
                alike = overlap((raw, starts), (other, begins), part.num_rows) >= similarity - 1e-9
                yield part.select(["a", "b"]).filter(pa.array(alike))

    return pairs.mapInArrow(run, "a long, b long")


def stars(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root), root the least node, for every node but the roots.

    Large-star and small-star steps in turn. Each is a minimum per node, taken before the
    shuffle where it can be, and one join back that splits a node with very many links. What a
    round shuffles stays on disk until the driver collects its garbage, so a round has few
    shuffles and none is run to learn that the one before was the last.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    edges = checkpointed(edges)
    while True:
        both = edges.select(F.inline(F.array(F.struct("v", "u"), F.struct(F.col("u").alias("v"), F.col("v").alias("u")))))
        # Done when all are stars: a node that has a lesser one has no other link.
        per_node = both.groupBy("v").agg(F.count("*").alias("links"), F.min("u").alias("m"))
        if per_node.filter("m < v AND links > 1").isEmpty():
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        # The greater end of each link goes to the least node around either end; around itself, once.
        around = both.join(least, "v").filter("u > v OR u = m")
        down = around.select(F.greatest("v", "u").alias("v"), F.col("m").alias("u")).distinct()
        lowest = down.groupBy("v").agg(F.min("u").alias("m"))
        # All of a node's links but the least go from there to the least; that one stays.
        up = F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u"))
        edges = checkpointed(down.join(lowest, "v").select(up.alias("v"), F.col("m").alias("u")).distinct())


def _compared(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that pass, with the texts of both sides fetched by row."""
    texts = rows.select("row", "text")
    a = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    return checkpointed(verified(pairs.join(a, "a").join(b, "b"), similarity))


def _could_be(similarity: float, registers: int) -> Column:
    """Whether members ``one`` and ``other`` can be similar: by their sizes, surely, and by their registers, with four standard errors.

    Plain longs, each used once: the join tests this for very many pairs, so it has to stay small enough to be compiled.
    """
    sizes = F.least("one_total", "other_total") >= similarity * F.greatest("one_total", "other_total")
    apart = F.lit(0)
    for group in range(0, registers * PLANES // 64, PLANES):
        differ = [F.col(f"one_{i}").bitwiseXOR(F.col(f"other_{i}")) for i in range(group, group + PLANES)]
        apart = apart + F.bit_count(reduce(Column.bitwiseOR, differ))
    agree = similarity + (1 - similarity) / 2**PLANES
    bar = registers * (1 - agree) + 4.2 * math.sqrt(registers * agree * (1 - agree))
    return sizes & (apart <= bar)


def _links(rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of all nodes that are similar to another."""
    spread = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    buckets = spread.select(F.col("row").alias("node"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = checkpointed(buckets.join(shared, "bucket"))
    # The texts move once, those of nodes that meet another; all comparisons fetch them from there.
    meeting = members.select(F.col("node").alias("row")).distinct()
    rows = checkpointed(rows.select("row", "text", "bands").join(meeting, "row", "left_semi"))
    central = members.groupBy("node").agg(F.sum("size").alias("c"))
    led = members.join(central, "node").groupBy("bucket").agg(F.max(F.struct("c", (-F.col("node")).alias("o"))).alias("x"))
    leader = checkpointed(led.select("bucket", (-F.col("x.o")).alias("leader")))
    first = checkpointed(_pairs(members.join(leader, "bucket").filter("node <> leader"), "node", "leader"))
    links = _compared(first, rows, similarity)
    roots = stars(links)
    own = members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    # A pair across classes has at least one member that is not of its leader's class.
    led_by = leader.join(roots.withColumnRenamed("node", "leader"), "leader", "left").select("bucket", F.coalesce("root", "leader").alias("of"))
    mixed_ = own.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    open_ = checkpointed(own.join(mixed_.join(led_by, "bucket"), "bucket"))
    texts = rows.select(F.col("row").alias("node"), "text", "bands").join(open_.select("node").distinct(), "node", "left_semi")
    brief = with_signature(texts, "text", "brief", WIDE, briefed)
    planes = [F.get("brief", F.lit(i)).alias(str(i)) for i in range(WIDE * PLANES // 64)]
    brief = brief.select("node", "total", "bands", *planes)
    # A pair that meets in several buckets is tested in the first of them.
    earlier = F.slice("bands", 1, F.array_position("bands", F.col("bucket")).cast("int") - 1).alias("earlier")
    open_ = checkpointed(open_.join(brief, "node").select("bucket", "node", "root", "of", "total", earlier, *map(str, range(len(planes)))))
    one = open_.filter("root <> of").select([F.col(f"`{c}`").alias(f"one_{c}") for c in open_.columns])
    other = open_.select([F.col(f"`{c}`").alias(f"other_{c}") for c in open_.columns])
    across = (F.col("one_bucket") == F.col("other_bucket")) & (F.col("one_root") != F.col("other_root"))
    once = (F.col("other_root") == F.col("other_of")) | (F.col("one_node") > F.col("other_node"))
    first_met = ~F.arrays_overlap("one_earlier", "other_earlier")
    met = one.join(other, across & once & _could_be(similarity, WIDE) & first_met)
    met = checkpointed(_pairs(met, "one_node", "other_node"))
    more = _compared(met.join(first, ["a", "b"], "left_anti"), rows, similarity)
    return roots if more.isEmpty() else stars(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def _pairs(df: DataFrame, one: str, other: str) -> DataFrame:
    return df.select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).distinct()


def classes(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: all its columns, and ``class_id``, ``class_size`` and ``is_first`` (columns of these names are replaced).

    ``class_id`` is the least key of the class (null if all keys in it are null), ``class_size`` its
    number of rows, and exactly one row of each class is ``is_first``: one that has the least key.
    Equal texts are of one class; a null text is an empty one. Texts without words other than equal
    ones have no likes. The classes are the components of the similarity links.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key_col}`").alias("key"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_hash"),
        text.alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col] or [F.lit(1)]).alias("rest"),
        F.col(f"`{text_col}`").isNull().alias("was_null"),
    )
    path = new_dir(spark, "signatures")
    with_signature(own, "text", "bands", BANDS * ROWS, banded).write.parquet(path)
    rows = spark.read.parquet(path)
    # The key is ordered first, so that the least key's row stands for equal texts.
    nodes = checkpointed(
        rows.groupBy("text_hash").agg(F.min("row").alias("node"), F.min("key").alias("key"), F.count("*").alias("n"))
    )
    roots = _links(rows, nodes, similarity)
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_class = placed.groupBy("root").agg(F.min("key").alias("class_id"), F.sum("n").alias("class_size"))
    told = checkpointed(placed.join(per_class, "root").select("text_hash", "root", "class_id", "class_size"))
    # Of the rows that carry the least key, the first one. Whole texts meet their class by their own hash alone.
    bearing = rows.select("row", "key", "text_hash").join(told, "text_hash").filter(F.col("key").eqNullSafe(F.col("class_id")))
    told = checkpointed(told.join(bearing.groupBy("root").agg(F.min("row").alias("first")), "root").drop("root"))
    out = rows.drop("bands", "total").join(told, "text_hash").withColumn("is_first", F.col("row") == F.col("first"))
    value = F.when(F.col("was_null"), F.lit(None)).otherwise(F.col("text"))
    added = ["class_id", "class_size", "is_first"]
    columns: list[Column] = [value.alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in df.columns if c not in added]
    return out.select(*columns, *added)

"""Large JSON array documents, read by many tasks.

A file that holds one array of objects has no line ends to split at, so it is
read as fragments that end in ``}``, which Spark's text source cuts in any byte
range. Whether a ``}`` ends an element depends on what stands before it: inside
a string, how deep. So a first pass tells for every range what it does to a
reader that enters it outside a string, and to one that enters it inside:
whether the reader leaves on the other side, and how much deeper. These maps
are composed in the order of the ranges, which gives the state at the start of
each. A second pass cuts every range into its elements on its own. What begins
in one range and ends in another leaves each of them as a piece, and the few
pieces are joined.

The texts stay with the task that reads them; only pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.shape import quoted
from tierline.workspace import new_dir

# Ranges whose states are broadcast, of some 50 bytes each; beyond it the fragments are dealt to them by a shuffle.
BROADCAST_RANGES = 1_000_000
# Bytes of text that are looked at together, more only where one fragment has more; a byte takes some 30 in working arrays.
RUN_BYTES = 1 << 20

_OPEN, _CLOSE, _QUOTE, _BACKSLASH = frozenset(b"{["), frozenset(b"}]"), ord('"'), ord("\\")
_END, _START, _LIST = ord("}"), ord("{"), ord("[")


def _table(values: bytes | frozenset) -> np.ndarray:
    known = np.zeros(256, bool)
    known[list(values)] = True
    return known


_STEP = _table(_OPEN).astype(np.int8) - _table(_CLOSE)
_BETWEEN = _table(b" \t\r\n,")


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, value, seq): texts between ``}``, with the byte range they are read in and their order."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value"),
        F.monotonically_increasing_id().alias("seq"),
    )


def _joined(batch: pa.RecordBatch) -> bytes:
    """The text of consecutive fragments, each with the ``}`` that ended it. A file's last one gains one, after its array."""
    return b"}".join([*batch.column("value").cast(pa.binary()).to_pylist(), b""])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Runs of fragments of one range, in order; a range takes several, by the size of batches and ``RUN_BYTES``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts, paths = batch.column("start"), batch.column("path")
        changed = pc.or_(pc.not_equal(starts[1:], starts[:-1]), pc.not_equal(paths[1:], paths[:-1]))
        ends = np.cumsum(pc.binary_length(batch.column("value")).to_numpy(zero_copy_only=False), dtype=np.int64)
        full = np.diff(ends // RUN_BYTES) > 0
        edges = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False) | full) + 1).tolist(), batch.num_rows]
        for at, end in zip(edges, edges[1:]):
            yield paths[at].as_py(), starts[at].as_py(), batch.slice(at, end - at)


def _outside(raw: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are outside strings, and which are quotes that begin or end one.

    No fragment begins behind a backslash: ``}`` is never escaped, so the one before it is escaped itself.
    """
    # An Arrow column of texts has less than 2^31 bytes.
    plain = np.where(raw != _BACKSLASH, np.arange(len(raw), dtype=np.int32), np.int32(-1))
    np.maximum.accumulate(plain, out=plain)
    quotes = np.flatnonzero(raw == _QUOTE)
    before = np.where(quotes > 0, plain[quotes - 1], -1)
    quotes = quotes[(quotes - 1 - before) % 2 == 0]
    is_quote = np.zeros(len(raw), bool)
    is_quote[quotes] = True
    return (np.logical_xor.accumulate(is_quote) == inside) & ~is_quote, is_quote


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, flips, outer, inner) of each run: whether it ends on the other side, and the levels it adds from either side."""
    for path, start, part in _parts(batches):
        raw = np.frombuffer(_joined(part), np.uint8)
        outside, quotes = _outside(raw, False)
        step = _STEP[raw]
        row = [path, start, int(quotes.sum()) % 2, int(step[outside].sum()), int(step[~outside & ~quotes].sum())]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["path", "start", "flips", "outer", "inner"])


def states(texts: DataFrame) -> DataFrame:
    """(path, start, inside, depth) at the start of each range: the maps of the ranges before it, composed.

    A range is cut into runs by the size of batches, and its runs are composed first, in the same way.
    """
    found = texts.select("path", "start", "value").mapInArrow(_maps, "path string, start long, flips long, outer long, inner long")
    runs = found.withColumn("run", F.monotonically_increasing_id())
    entered = F.coalesce(F.sum("flips").over(Window.partitionBy("path").orderBy("start", "run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    told = runs.withColumn("inside", entered).withColumn("deeper", F.when(F.col("inside") == 0, F.col("outer")).otherwise(F.col("inner")))
    ranges = told.groupBy("path", "start").agg(F.min_by("inside", "run").alias("inside"), F.sum("deeper").alias("deeper"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("path", "start", "inside", F.coalesce(F.sum("deeper").over(before), F.lit(0)).alias("depth"))


class _Cutter:
    """Cuts the runs of one range into elements; keeps what is not complete yet."""

    def __init__(self, path: str, start: int, inside: bool, depth: int) -> None:
        self.path, self.start = path, start
        self.inside, self.depth = inside, depth
        self.head: bytes | None = None
        self.open = [b""]

    def cut(self, text: bytes) -> list[bytes]:
        raw = np.frombuffer(text, np.uint8)
        outside, quotes = _outside(raw, self.inside)
        step = _STEP[raw] * outside
        depth = np.cumsum(step, dtype=np.int32) + np.int32(self.depth)
        before = depth - step
        first = self.depth == 0 and self.start == 0 and self.head is None and not any(self.open)
        self._check(raw, outside | quotes, depth, before, first)
        ends = np.flatnonzero((raw == _END) & outside & (depth == 1)) + 1
        self.inside = bool((int(quotes.sum()) + self.inside) % 2)
        self.depth = int(depth[-1])
        if not len(ends):
            self.open.append(text)
            return []
        elements = [text[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        elements[0] = b"".join([*self.open, elements[0]])
        self.open = [text[ends[-1] :]]
        if self.head is None:
            self.head = elements.pop(0)
        return elements

    def _check(self, raw: np.ndarray, seen: np.ndarray, depth: np.ndarray, before: np.ndarray, first: bool) -> None:
        """Only objects may stand in the array, and only the array in the file."""
        own = (before == 1) & (depth == 1) | (before == 1) & (depth == 2) & (raw != _START)
        wrong = own & seen & ~_BETWEEN[raw]
        if first:
            solid = np.flatnonzero(~_BETWEEN[raw] & (raw < 0x80))
            # The } after the last fragment is all there is in a file of spaces.
            if len(solid) and raw[solid[0]] != _LIST and not (len(solid) == 1 and raw[solid[0]] == _END):
                raise ValueError(f"{self.path} does not hold an array")
        if wrong.any():
            raise ValueError(f"{self.path} holds an array with something else than objects")

    def pieces(self) -> list[tuple[int, bytes, bool]]:
        """(place, text, ends an element) of what is left at either side."""
        rest = b"".join(self.open)
        return [(0, rest, False)] if self.head is None else [(0, self.head, True), (1, rest, False)]


_CUT = pa.schema([("path", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("ends", pa.bool_()), ("value", pa.binary())])


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, place, ends, value): complete elements, whose place is null, and the pieces of ranges."""

    def left(cutter: _Cutter | None) -> Iterator[pa.RecordBatch]:
        if cutter is not None:
            rows = [(cutter.path, cutter.start, place, ends, text) for place, text, ends in cutter.pieces()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CUT)], schema=_CUT)

    cutter = None
    for path, start, part in _parts(batches):
        if cutter is None or (cutter.path, cutter.start) != (path, start):
            yield from left(cutter)
            cutter = _Cutter(path, start, bool(part.column("inside")[0].as_py()), part.column("depth")[0].as_py())
        elements = cutter.cut(_joined(part))
        if elements:
            n = len(elements)
            columns = [pa.array([path] * n), pa.array([start] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([True] * n), pa.array(elements, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_CUT)
    yield from left(cutter)


def elements(spark: SparkSession, path: str) -> DataFrame:
    """The objects of array documents, each as its JSON text in ``value``; one document per file."""
    texts = fragments(spark, path)
    kept = new_dir(spark, "ranges")
    states(texts).write.parquet(kept)
    at = spark.read.parquet(kept)
    if at.count() <= BROADCAST_RANGES:
        told = texts.join(F.broadcast(at), ["path", "start"])
    else:
        told = texts.join(at, ["path", "start"]).repartition("path", "start").sortWithinPartitions("path", "start", "seq")
    folder = new_dir(spark, "elements")
    schema = "path string, start long, place long, ends boolean, value binary"
    told.select("path", "start", "value", "inside", "depth").mapInArrow(_cuts, schema).write.parquet(folder)
    cut = spark.read.schema(schema).parquet(folder)
    pieces = cut.filter("place IS NOT NULL")
    order = Window.partitionBy("path").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.col("ends").cast("long")).over(order), F.lit(0))
    # The pieces of one element; an element is a record, so they fit into a row.
    joined = F.expr("listagg(value) WITHIN GROUP (ORDER BY start, place)")
    stitched = pieces.withColumn("number", number).groupBy("path", "number").agg(joined.alias("value"), F.max("ends").alias("ends"))
    # What is left behind the last element of a file ends nothing.
    found = cut.filter("place IS NULL").select("value").union(stitched.filter("ends").select("value"))
    text = F.decode("value", "UTF-8")
    # A byte order mark, the bracket of the array, and what separates elements.
    return found.select(F.regexp_replace(text, r"\A[^{]*+", "").alias("value"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows ``read_json(..., multi_line=True)`` gives for array documents, but by many tasks per file.

    Each file holds one array of objects, with any white space, nesting, brackets and quotes in texts; an empty array or
    file gives no rows. Elements that are no objects, and files that hold something else, are an error. The schema has to be
    named. A compressed file cannot be split and is one range.
    """
    own = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    record = F.from_json("value", own).alias("r")
    return elements(spark, path).select(record).select(*[F.col(f"r.{quoted(f.name)}").alias(f.name) for f in own])

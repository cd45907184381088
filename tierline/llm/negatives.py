"""Hard negatives by coordinate pruning in length buckets.

Rows are sorted by the length of their vector, over all tasks, and cut into
buckets of ``BUCKET`` rows of nearly one length. A bucket holds, for every
coordinate, the order of its vectors by the value of that coordinate after
scaling them to length one. A search with a least score s turns it into a least
cosine for the bucket, s / (anchor's length x greatest length in the bucket),
an angle. Along a coordinate two unit vectors are no further apart, as angles
from that axis, than they are in full. So each of the anchor's focus
coordinates, its largest ones, allows one range of values, which is a run of
the sorted list, and only vectors in all of these runs are multiplied out.

Blocks of anchors travel to the buckets, which stay where they are. The search
for positives raises its least score to the k-th best of some buckets before it
goes through all. The search for negatives does so within the window of scores
of each positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.topk import products
from tierline.workspace import checkpointed

SCALE = 256
POSITIVES = 5
NEGATIVES = 10

BUCKET = 4096
ANCHORS = 512
FOCUS = 3
# Buckets that a task sorts, at least this many tasks, and one in so many buckets to raise the least scores with.
RUN = 16
TASKS = 8
SEEDS = 16
SLACK = 1e-9
NONE = np.iinfo(np.int64).min

BUCKETS = "dims long, ids binary, labels binary, vectors binary, orders binary, longest double"
BLOCKS = "dims long, rows binary, ids binary, labels binary, vectors binary, scores binary, floors binary"


def whole(vector: Column) -> Column:
    """floor(256 * x) of every component, or null if the vector may not take part."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(fits, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.int64).reshape(len(lists), dims)


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with vectors of one number of dimensions, ``size`` at most."""
    held: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        sizes = np.asarray(batch.column("v").value_lengths())
        for dims in np.unique(sizes):
            held.setdefault(int(dims), []).append(batch.filter(pa.array(sizes == dims)))
            own = pa.Table.from_batches(held[dims])
            while own.num_rows >= size:
                yield own.slice(0, size).combine_chunks().to_batches()[0]
                own = own.slice(size)
            held[int(dims)] = own.to_batches()
    for rest in held.values():
        if rest:
            yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def units(matrix: np.ndarray) -> np.ndarray:
    """The vectors at length one; a zero vector stays zero."""
    real = matrix.astype(np.float64)
    return real / np.maximum(np.linalg.norm(real, axis=1), 1e-300)[:, None]


def _row(schema: str, values: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    named = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for v, (_, k) in zip(values, named)], [n for n, _ in named])


def buckets(rows: DataFrame, count: int) -> DataFrame:
    """Length buckets with sorted coordinate lists, ``number`` and ``seed``, of rows (row, id, label, v, norm)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, BUCKET):
            dims = len(run.column("v")[0])
            matrix = _matrix(run.column("v"), dims)
            orders = np.argsort(units(matrix), axis=0, kind="stable").astype(np.uint16)
            longest = float(np.linalg.norm(matrix.astype(np.float64), axis=1).max())
            ids, labels = (np.asarray(run.column(c), np.int64).tobytes() for c in ("id", "label"))
            yield _row(BUCKETS, [dims, ids, labels, matrix.tobytes(), orders.T.tobytes(), longest])

    tasks = max(TASKS, -(-count // (RUN * BUCKET)))
    ordered = rows.repartitionByRange(tasks, F.desc("norm"), "row").sortWithinPartitions(F.desc("norm"), "row")
    made = checkpointed(ordered.select("id", "label", "v").mapInArrow(pack, BUCKETS).withColumn("number", F.monotonically_increasing_id()))
    # The low bits count the buckets of a task; the first one holds its longest vectors.
    return made.withColumn("seed", F.col("number").bitwiseAND(2**33 - 1) % SEEDS == 0)


def blocks(anchors: DataFrame, count: int) -> DataFrame:
    """Anchors (row, id, label, v, scores, floors) in blocks; scores of positives and the least score wanted beside each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ANCHORS):
            dims = len(run.column("v")[0])
            numbers = [np.asarray(run.column(c), np.int64).tobytes() for c in ("row", "id", "label")]
            lists = []
            for c in ("scores", "floors"):
                padded = np.full((run.num_rows, POSITIVES), NONE)
                sizes = np.asarray(run.column(c).value_lengths())
                padded[np.arange(POSITIVES) < sizes[:, None]] = np.asarray(run.column(c).flatten(), np.int64)
                lists.append(padded.tobytes())
            yield _row(BLOCKS, [dims, *numbers, _matrix(run.column("v"), dims).tobytes(), *lists])

    dealt = anchors.repartition(max(1, -(-count // ANCHORS)), "row")
    return dealt.select("row", "id", "label", "v", "scores", "floors").mapInArrow(pack, BLOCKS)


def feasible(unit: np.ndarray, least: float, values: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Places in a bucket whose focus coordinates allow a cosine of ``least``. ``values`` are unit vectors, ``orders`` the sorted lists."""
    if least > 1 + SLACK:
        return np.zeros(0, np.int64)
    angle = math.acos(max(min(least - SLACK, 1.0), -1.0))
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    runs = []
    for f in focus:
        own = math.acos(max(min(unit[f], 1.0), -1.0))
        low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
        listed = values[orders[f], f]
        runs.append((int(np.searchsorted(listed, low)), int(np.searchsorted(listed, high, "right")), f, low, high))
    if not runs:
        return np.arange(len(values))
    # The shortest run, and of it what lies in the others.
    runs.sort(key=lambda r: r[1] - r[0])
    start, end, f, _, _ = runs[0]
    left = orders[f, start:end].astype(np.int64)
    for _, _, f, low, high in runs[1:]:
        left = left[(values[left, f] >= low) & (values[left, f] <= high)]
    return left


def _most(score: int) -> int:
    """The greatest n with 100 * n <= 90 * score."""
    return (9 * score) // 10


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _searched(pairs: DataFrame, negatives: bool) -> DataFrame:
    """(row, positive, id, score): in each pair of a block and a bucket, what may be among the first of each anchor or positive."""

    def one(row: dict) -> Iterator[tuple[np.ndarray, ...]]:
        dims = row["dims"]
        ids, labels = _numbers(row["ids_c"]), _numbers(row["labels_c"])
        matrix = _numbers(row["vectors_c"]).reshape(len(ids), dims)
        orders = np.frombuffer(row["orders"], np.uint16).reshape(dims, len(ids))
        rows, own_ids, own_labels = (_numbers(row[c]) for c in ("rows", "ids", "labels"))
        vectors = _numbers(row["vectors"]).reshape(len(rows), dims)
        wanted, floors = (_numbers(row[c]).reshape(len(rows), POSITIVES) for c in ("scores", "floors"))
        values, aims = units(matrix), units(vectors)
        reach = np.linalg.norm(vectors.astype(np.float64), axis=1) * row["longest"]
        for i in range(len(rows)):
            searches = [p for p in range(POSITIVES) if wanted[i, p] != NONE] if negatives else [0]
            if not searches:
                continue
            floor = int(floors[i, searches].min())
            # Scores of zero and less say nothing on the angle of vectors that are shorter than the longest.
            least = -1.0 if floor <= 0 else floor / reach[i] if reach[i] > 0 else 2.0
            left = feasible(aims[i], least, values, orders) if floor > 0 else np.arange(len(ids))
            left = left[labels[left] != own_labels[i]] if negatives else left[(labels[left] == own_labels[i]) & (ids[left] != own_ids[i])]
            if not len(left):
                continue
            score = products(vectors[i : i + 1], matrix[left])[0]
            for p in searches:
                fits = score >= floors[i, p]
                if negatives:
                    fits &= score <= _most(int(wanted[i, p]))
                at = np.flatnonzero(fits)
                at = at[_first(score[at], ids[left[at]], NEGATIVES if negatives else POSITIVES)]
                yield np.full(len(at), rows[i]), np.full(len(at), p), ids[left[at]], score[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                found = list(one(batch.slice(at, 1).to_pylist()[0]))
                if found:
                    columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "positive", "id", "score"])

    return pairs.mapInArrow(run, "row long, positive long, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("row", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


class _Search:
    """Buckets dealt to parts, which every block of anchors is sent to."""

    def __init__(self, made: DataFrame) -> None:
        n = made.agg(F.count("*").alias("n")).first().n
        self.parts = max(1, -(-n // RUN), min(n, TASKS))
        part = F.pmod(F.xxhash64("number"), F.lit(self.parts))
        names = {"ids": "ids_c", "labels": "labels_c", "vectors": "vectors_c"}
        self.buckets = made.select(part.alias("part"), "seed", *[F.col(c).alias(names.get(c, c)) for c in ("dims", "ids", "labels", "vectors", "orders", "longest")])

    def run(self, asked: DataFrame, negatives: bool, seeds: bool) -> DataFrame:
        own = self.buckets.filter("seed") if seeds else self.buckets
        sent = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.parts - 1).cast("long"))))
        return _searched(own.drop("seed").join(sent, ["part", "dims"]), negatives)


def _raised(anchors: DataFrame, seeded: DataFrame, k: int) -> DataFrame:
    """The anchors with their least scores raised to the k-th best that the seeds have."""
    kth = _ranked(seeded, k).filter(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("positive", "score"))).alias("kth"))
    # At most one entry for each of the POSITIVES of an anchor.
    told = anchors.join(kth, "row", "left")
    better = F.transform("floors", lambda x, i: F.greatest(x, F.try_element_at("kth", i.cast("long"))))
    return told.withColumn("floors", F.when(F.col("kth").isNull(), F.col("floors")).otherwise(better)).drop("kth")


def mine(
    df: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding"
) -> DataFrame:
    """The first hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` says which rows of ``df`` are anchors. An anchor's positives are the first ``POSITIVES`` rows of its label
    with another id, its negatives for one of them the first ``NEGATIVES`` rows of other labels with 30 to 90 percent of the
    positive's score; first is by score, ties by the smaller id. Rows with a null id or label, and vectors that are null or
    hold a null or no finite number, take no part; vectors of different lengths do not meet. Repeated rows are rows each.
    Anchors without positives, and positives without negatives, give no rows. Scores must stay
    below 2^60.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    own = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        whole(F.col(f"`{vector_col}`")).alias("v"),
        anchors.alias("asks"),
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    rows = checkpointed(own.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("norm", norm))
    counts = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("anchors")).first()
    if not counts.anchors:
        return df.sparkSession.createDataFrame([], schema)
    search = _Search(buckets(rows.drop("asks"), counts.rows))
    no_scores = F.array().cast("array<bigint>").alias("scores")
    asking = rows.filter("asks").select("row", "id", "label", "v", no_scores, F.array(F.lit(NONE + 1)).alias("floors"))

    seeded = search.run(blocks(asking, counts.anchors), negatives=False, seeds=True)
    raised = _raised(asking, seeded, POSITIVES)
    best = _ranked(search.run(blocks(raised, counts.anchors), negatives=False, seeds=False), POSITIVES)
    best = checkpointed(best.select("row", (F.col("rank") - 1).cast("long").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    per = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("positive", "positive_score"))).alias("p"))
    scores = F.transform("p", lambda x: x["positive_score"])
    # The least n with 30 * score <= 100 * n. Below zero no n fits, whatever this says.
    floors = F.expr("transform(p, x -> (3 * x.positive_score + 9) div 10)")
    wanting = checkpointed(asking.select("row", "id", "label", "v").join(per, "row").withColumn("scores", scores).withColumn("floors", floors).drop("p"))
    seeded = search.run(blocks(wanting, counts.anchors), negatives=True, seeds=True)
    raised = _raised(wanting, seeded, NEGATIVES)
    found = _ranked(search.run(blocks(raised, counts.anchors), negatives=True, seeds=False), NEGATIVES)
    told = found.join(best, ["row", "positive"]).join(asking.select("row", F.col("id").alias("anchor_id")), "row")
    return told.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS vec_id, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""

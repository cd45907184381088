"""Exact top-k search: every candidate is scored, and histograms find each query's k-th value.

Queries and candidates are packed into blocks, and a block of queries meets all
candidate blocks over a shuffle, as one matrix product each. Nothing is kept of
the scores. Each pass counts them in a histogram of the interval that still
holds the query's k-th score and narrows that interval to one bin, until it is
one value. Ties at that value are told apart the same way, by histograms of
their ids. A last pass returns exactly the candidates at or before the k-th
place; a small window ranks them.

A block of candidates only reports the bins down to where it alone has k, as
the k-th of all cannot lie below that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.workspace import checkpointed

SCALE = 64
BINS = 256
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
EXACT = 2**52

STATE = "block long, ids binary, vectors binary, lo binary, hi binary, need binary, phase binary, cut binary, open boolean"


def whole(vector: Column) -> Column:
    """floor(64 * x) of every component, or null if the vector may not take part."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(fits, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def _packed(ids: np.ndarray, lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, matrix) for each length of vector that occurs."""
    sizes = np.asarray(lists.value_lengths())
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        flat = np.asarray(lists.take(pa.array(at)).flatten(), np.int64)
        yield int(length), ids[at], flat.reshape(len(at), int(length))


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if bound < EXACT:
        return np.rint(queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def _candidate_blocks(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CANDIDATE_BLOCK):
                part = batch.slice(at, CANDIDATE_BLOCK)
                for length, ids, matrix in _packed(np.asarray(part.column("id")), part.column("v")):
                    yield pa.RecordBatch.from_pylist(
                        [{"length": length, "ids_c": ids.tobytes(), "vectors_c": matrix.tobytes(), "most": int(np.abs(matrix).max(initial=0))}],
                        pa.schema([("length", pa.int64()), ("ids_c", pa.binary()), ("vectors_c", pa.binary()), ("most", pa.int64())]),
                    )

    return rows.mapInArrow(run, "length long, ids_c binary, vectors_c binary, most long")


def _start(queries: DataFrame, most: int, k: int) -> DataFrame:
    """Blocks of queries, each with the interval of scores that is possible for it."""

    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        ids = batch["id"].to_numpy(np.int64)
        matrix = np.array(batch["v"].tolist(), np.int64).reshape(len(ids), -1)
        reach = np.abs(matrix).sum(1) * most + 1
        state = [ids, matrix, -reach, reach, np.full(len(ids), k), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)]
        names = ["block", "ids", "vectors", "lo", "hi", "need", "phase", "cut", "open"]
        return pd.DataFrame([[int(batch["block"].iloc[0]), *[x.astype(np.int64).tobytes() for x in state], True]], columns=names)

    return queries.groupBy("block", "length").applyInPandas(pack, STATE)


def _numbers(*columns: bytes) -> list[np.ndarray]:
    return [np.frombuffer(c, np.int64) for c in columns]


def _met(row: dict) -> tuple[np.ndarray, ...]:
    """A pair of blocks: query ids, candidate ids, scores, and which candidates are others than the query."""
    ids, others = _numbers(row["ids"], row["ids_c"])
    queries, candidates = (np.frombuffer(row[c], np.int64) for c in ("vectors", "vectors_c"))
    length = row["length"]
    scores = products(queries.reshape(len(ids), length), candidates.reshape(len(others), length))
    return ids, others, scores, ids[:, None] != others


def _width(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return np.maximum((hi - lo) // BINS + ((hi - lo) % BINS > 0), 1)


def _histograms(pairs: DataFrame) -> DataFrame:
    """(block, slot, bin, n): the upper bins of each query; its interval is (lo, hi] of scores, or of minus ids among ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, others, scores, ok = _met(row)
                lo, hi, need, phase, cut = _numbers(*(row[c] for c in ("lo", "hi", "need", "phase", "cut")))
                value = np.where(phase[:, None] == 0, scores, -others)
                ok &= (phase[:, None] == 0) | (scores == cut[:, None])
                ok &= (value > lo[:, None]) & (value <= hi[:, None]) & (phase[:, None] < 2)
                slot, at = np.nonzero(ok)
                bin_ = (hi[slot] - value[slot, at]) // _width(lo, hi)[slot]
                n = np.bincount(slot * BINS + bin_, minlength=len(ids) * BINS).reshape(len(ids), BINS)
                before = np.cumsum(n, axis=1) - n
                slot, bin_ = np.nonzero((n > 0) & (before < need[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), row["block"])), pa.array(slot), pa.array(bin_), pa.array(n[slot, bin_])], ["block", "slot", "bin", "n"]
                )

    return pairs.mapInArrow(run, "block long, slot long, bin long, n long").groupBy("block", "slot", "bin").agg(F.sum("n").alias("n"))


def _narrowed(state: DataFrame, histograms: DataFrame, low_id: int, high_id: int) -> DataFrame:
    """Each query's interval becomes the bin with its k-th value; a single score goes on with ids, a single id is done."""

    def step(one: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if not len(one):
            return one
        lo, hi, need, phase, cut = (x.copy() for x in _numbers(*(one[c].iloc[0] for c in ("lo", "hi", "need", "phase", "cut"))))
        n = np.zeros((len(lo), BINS), np.int64)
        n[counts["slot"].to_numpy(np.int64), counts["bin"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
        total = np.cumsum(n, axis=1)
        width = _width(lo, hi)
        open_ = phase < 2
        short = open_ & (total[:, -1] < need)
        bin_ = (total < need[:, None]).sum(1)
        go = np.flatnonzero(open_ & ~short)
        need[go] -= total[go, bin_[go]] - n[go, bin_[go]]
        hi[go] = hi[go] - bin_[go] * width[go]
        lo[go] = np.maximum(lo[go], hi[go] - width[go])
        # All that is left is wanted: everything there is, or exactly the ties at the cut.
        rest = n[go, bin_[go]] == need[go]
        one_value = hi[go] - lo[go] == 1
        scored, by_id = go[one_value & (phase[go] == 0)], go[(one_value | rest) & (phase[go] == 1)]
        ties = n[scored, bin_[scored]] > need[scored]
        cut[scored] = hi[scored]
        phase[scored] = np.where(ties, 1, 2)
        lo[scored], hi[scored] = np.where(ties, -high_id - 1, lo[scored]), np.where(ties, -low_id, -low_id)
        lo[scored[~ties]] = -high_id - 1
        phase[by_id] = 2
        cut[short] = np.where(phase[short] == 0, np.iinfo(np.int64).min, cut[short])
        lo[short] = -high_id - 1
        phase[short] = 2
        out = one.copy()
        for c, x in (("lo", lo), ("hi", hi), ("need", need), ("phase", phase), ("cut", cut)):
            out[c] = [x.tobytes()]
        out["open"] = bool((phase < 2).any())
        return out

    return state.groupBy("block").cogroup(histograms.groupBy("block")).applyInPandas(step, STATE)


def _chosen(pairs: DataFrame) -> DataFrame:
    """Candidates above the cut, and those at it whose id is early enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, others, scores, ok = _met(row)
                lo, cut = _numbers(row["lo"], row["cut"])
                ok &= (scores > cut[:, None]) | (scores == cut[:, None]) & (-others > lo[:, None])
                q, c = np.nonzero(ok)
                columns = [np.full(len(q), row["block"]), q, ids[q], others[c], scores[q, c]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["block", "slot", "query_id", "id", "score"])

    return pairs.mapInArrow(run, "block long, slot long, query_id long, id long, score long")


def search(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query row with all other rows: query_id, rank, id, score.

    ``queries`` says which rows are queries. Ties go to the smaller id. Rows with a null id, and vectors that are null or
    hold a null or no finite number, take no part. Vectors of different lengths do not meet. A row is "other" if its id
    is; repeated rows are candidates each, and each row that is a query gets its own answer.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole(F.col(f"`{vector_col}`")).alias("v"), queries.alias("asks"))
    rows = checkpointed(rows.filter("id is not null and v is not null"))
    blocks = checkpointed(_candidate_blocks(rows.select("id", "v")))
    bounds = rows.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.sum(F.col("asks").cast("long")).alias("n")).first()
    schema = "query_id long, rank int, id long, score long"
    if not bounds.n:
        return df.sparkSession.createDataFrame([], schema)
    most = blocks.agg(F.max("most").alias("m")).first().m
    n_blocks = -(-bounds.n // QUERY_BLOCK)
    asked = rows.filter("asks").select(
        "id", "v", F.size("v").cast("long").alias("length"), (F.pmod(F.xxhash64("id"), F.lit(n_blocks)) * 4096 + F.size("v") % 4096).alias("block")
    )
    state = checkpointed(_start(asked, max(most, 1), k))
    # Which query blocks a candidate block meets is a short list of numbers: one row per query block and length.
    lengths = asked.select("block", "length").distinct().groupBy("length").agg(F.collect_list("block").alias("met"))
    spread = blocks.join(lengths, "length").select("length", "ids_c", "vectors_c", F.explode("met").alias("block"))
    while not state.filter("open").isEmpty():
        state = checkpointed(_narrowed(state, _histograms(spread.join(state, "block")), bounds.low, bounds.high))
    found = _chosen(spread.join(state, "block"))
    place = Window.partitionBy("block", "slot").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

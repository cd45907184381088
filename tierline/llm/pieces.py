"""SentencePiece byte-pair pieces: encoding by vectorised merge rounds, and decoding.

All words of a block of texts are one flat array of symbols. A round finds the
best pair of every word that can still merge, merges its occurrences from the
left, and closes the gaps; words without a pair leave. Each distinct word of a
block is merged once. A word is a run of spaces with what follows it, since no
piece has a space after another character (the model is checked for that).

Merging several occurrences at once equals merging one by one unless a merge
makes a pair that is due at once. Pieces for which that can happen are known
from the vocabulary: for them a round merges the leftmost occurrence only. The
few words that are still open after many rounds, such as very long runs of
spaces, are finished with a heap, which gives the same pieces in n log n steps.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.flat import blocks, code_points, hashed, spread

SPACE = 0x2581
NEVER = np.int32(2**31 - 1)
ROUNDS = 96
# Bytes of text, and ids, that a task works on at a time.
TEXT_BLOCK = 600_000
ID_BLOCK = 150_000
UNKNOWN_SURFACE = " ⁇ "


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("tierline-each-byte", _each_byte)


class Pieces:
    """The tables of a model; one per Python worker and model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.size = size
        texts = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
        ids = {texts[i]: i for i in range(size) if plain[i]}
        if any(chr(SPACE) in t.lstrip(chr(SPACE)) for t in ids):
            raise ValueError("the model has a piece with a space after another character")
        if model.normalize("  ﬁ ½ ") not in ("▁▁▁ﬁ▁½▁", "  ﬁ ½ "):
            raise ValueError("the model normalises texts in a way that is not built here")
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(texts[i][3:-1], 16)] = i
        self.of_point = np.full(0x110000, -1, np.int32)
        for text, i in ids.items():
            if len(text) == 1:
                self.of_point[ord(text)] = i
        if any(self.of_point[ord(c)] < 0 for t in ids for c in t):
            raise ValueError("the model has a piece with a character that is no piece")
        scores = np.array([model.get_score(i) for i in range(size)])
        ranks = np.searchsorted(np.unique(-scores), -scores).astype(np.int32)
        pairs = sorted(
            (ids[t[:k]] * size + ids[t[k:]], i) for t, i in ids.items() for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids
        )
        self.keys = np.array([k for k, _ in pairs], np.int64)
        self.made = np.array([i for _, i in pairs], np.int32)
        self.rank_of = ranks
        self.hasty = np.zeros(int(ranks.max()) + 1, bool)
        for part in (self.keys // size, self.keys % size):
            self.hasty[ranks[part[ranks[self.made] <= ranks[part]]]] = True
        surfaces = []
        for i in range(size):
            if model.is_byte(i):
                surfaces.append(bytes([int(texts[i][3:-1], 16)]))
            elif model.is_control(i):
                surfaces.append(b"")
            else:
                surfaces.append((UNKNOWN_SURFACE if model.is_unknown(i) else texts[i].replace(chr(SPACE), " ")).encode())
        self.surface_lengths = np.array([len(s) for s in surfaces], np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths
        self.surfaces = np.frombuffer(b"".join(surfaces), np.uint8)
        self.opens_with_space = np.array([s[:1] == b" " and plain[i] for i, s in enumerate(surfaces)])

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of what two neighbours make; NEVER where they make nothing."""
        known = (left < self.size) & (right < self.size)
        keys = np.where(known, left.astype(np.int64) * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        made = np.where(hit, self.made[at], 0)
        return np.where(hit, self.rank_of[made], NEVER), made

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of each word: symbols one after another, and how many each word has."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(symbols), NEVER, np.int32)
        made = np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            rank[:-1], made[:-1] = self.pairs(symbols[:-1], symbols[1:])
            rank[:-1][owner[1:] != owner[:-1]] = NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for turn in range(ROUNDS + 1):
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            if not len(heads):
                break
            sizes = np.diff(heads, append=len(owner))
            best = np.minimum.reduceat(rank, heads)
            open_ = np.repeat(best < NEVER, sizes)
            if not open_.all():
                done.append((symbols[~open_], owner[~open_]))
                symbols, owner, rank, made = symbols[open_], owner[open_], rank[open_], made[open_]
                sizes, best = sizes[best < NEVER], best[best < NEVER]
            if not len(symbols):
                break
            if turn == ROUNDS:
                done.extend(self._by_heap(symbols[part], owner[part]) for part in np.split(np.arange(len(owner)), np.cumsum(sizes)[:-1]))
                break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            first = np.diff(owner[at], prepend=-1) > 0
            at = at[first | ~np.repeat(self.hasty[best], sizes)[at]]
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            fresh = np.zeros(len(symbols), bool)
            fresh[at] = True
            symbols, owner, rank, made, fresh = symbols[keep], owner[keep], rank[keep], made[keep], fresh[keep]
            rank[-1] = NEVER
            look = fresh.copy()
            look[:-1] |= fresh[1:]
            look = np.flatnonzero(look[:-1])
            rank[fresh] = NEVER
            rank[look], made[look] = self.pairs(symbols[look], symbols[look + 1])
            rank[look[owner[look] != owner[look + 1]]] = NEVER
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
        flat, owners = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owners, kind="stable")
        return flat[order], np.bincount(owners, minlength=len(lengths))

    def _by_heap(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = symbols.tolist()
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] < len(text)]
            if lefts:
                a, b = np.array([text[i] for i in lefts]), np.array([text[after[i]] for i in lefts])
                for i, x, y, r, m in zip(lefts, a.tolist(), b.tolist(), *(v.tolist() for v in self.pairs(a, b))):
                    if r < NEVER:
                        heapq.heappush(heap, (r, i, x, y, m))

        offer(list(range(len(text) - 1)))
        while heap:
            _, i, x, y, m = heapq.heappop(heap)
            j = after[i]
            if text[i] != x or j >= len(text) or text[j] != y:
                continue
            text[i], text[j] = m, -1
            after[i] = after[j]
            if after[i] < len(text):
                before[after[i]] = i
            offer([before[i], i])
        left = np.array([t for t in text if t >= 0], np.int32)
        return left, np.full(len(left), owner[0])

    def encode(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text starts among them."""
        points, begins = code_points(raw, starts)
        filled = np.flatnonzero(np.diff(begins))
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        points = np.insert(np.where(points == 0x20, SPACE, points), begins[filled], SPACE)
        opens = begins[filled] + np.arange(len(filled))
        space = points == SPACE
        edge = space.copy()
        edge[1:] &= ~space[:-1]
        edge[opens] = True
        first = np.flatnonzero(edge)
        lengths = np.diff(first, append=len(points))
        _, sample, same = np.unique(hashed(points, first, lengths), return_index=True, return_inverse=True)
        # Words are one if they are equal, not if their hashes are.
        twin = points[spread(first[sample][same], np.minimum(lengths, lengths[sample][same]))]
        own = points[spread(first, np.minimum(lengths, lengths[sample][same]))]
        heads = np.cumsum(np.minimum(lengths, lengths[sample][same]))
        other = np.add.reduceat(own != twin, np.concatenate([[0], heads[:-1]])) > 0
        other = np.flatnonzero(other | (lengths != lengths[sample][same]))
        same[other] = len(sample) + np.arange(len(other))
        sample = np.concatenate([sample, other])
        known = self.of_point[points]
        symbols = np.where(known >= 0, known, self.size + points.astype(np.int64)).astype(np.int32)
        own, counts = self.merged(symbols[spread(first[sample], lengths[sample])], lengths[sample])
        own, counts = self._with_bytes(own, counts)
        heads = np.cumsum(counts) - counts
        ids = own[spread(heads[same], counts[same])]
        totals = np.concatenate([[0], np.cumsum(counts[same])])
        ends = totals[np.searchsorted(first, np.append(opens[1:], len(points)))]
        per_text = np.zeros(len(starts) - 1, np.int64)
        per_text[filled] = np.diff(ends, prepend=0)
        return ids, np.concatenate([[0], np.cumsum(per_text)])

    def _with_bytes(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the pieces of their bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, counts
        points = symbols[odd] - self.size
        width = np.ones(len(symbols), np.int64)
        width[odd] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        out = np.repeat(symbols, width)
        encoded = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        out[spread((np.cumsum(width) - width)[odd], width[odd])] = self.byte_ids[encoded]
        owner = np.repeat(np.repeat(np.arange(len(counts)), counts), width)
        return out, np.bincount(owner, minlength=len(counts))

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts of lists of ids, and where each starts."""
        lengths = self.surface_lengths[ids]
        raw = self.surfaces[spread(self.surface_starts[ids], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[starts]
        filled = np.flatnonzero(np.diff(starts))
        led = filled[self.opens_with_space[ids[starts[:-1][filled]]]]
        raw = np.delete(raw, ends[led])
        cut = np.zeros(len(starts), np.int64)
        cut[led + 1] = 1
        ends = ends - np.cumsum(cut)
        try:
            raw.tobytes().decode()
            return raw, ends
        except UnicodeDecodeError:
            texts = [raw[a:b].tobytes().decode("utf-8", "tierline-each-byte").encode() for a, b in zip(ends[:-1], ends[1:])]
            return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds the ids of each text, as the library encodes it without begin, end or sampling. Null is empty.

    ``model_path`` is a file on every machine. Rows and other columns stay; a column of the name
    of the ids is replaced.
    """
    base = df.drop(ids_col)
    schema = T.StructType([*base.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for part, raw, starts in blocks(batches, text_col, TEXT_BLOCK):
            ids, places = model.encode(raw, starts)
            column = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids_col])

    return base.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of each list of ids, as the library decodes it; null ids give an empty text."""
    base = df.drop(text_col)
    schema = T.StructType([*base.schema, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            sizes = np.asarray(batch.column(ids_col).value_lengths().fill_null(0), np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(ends, ends[at] + ID_BLOCK, "right")) - 1)
                part = batch.slice(at, end - at)
                raw, places = model.decode(np.asarray(part.column(ids_col).flatten()), ends[at : end + 1] - ends[at])
                buffers = [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw.tobytes())]
                text = pa.Array.from_buffers(pa.large_string(), part.num_rows, buffers).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, text_col])
                at = end

    return base.mapInArrow(run, schema)


def digest(df: DataFrame, model_path: str) -> DataFrame:
    """Number and hash of the ids of every document, and hash of what they decode to."""
    coded = decode(encode(df.select("doc_id", "text"), model_path).drop("text"), model_path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

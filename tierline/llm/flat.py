"""Many texts as one flat numpy array, for tasks that work on whole Arrow batches.

Texts are cut into blocks of about ``BLOCK`` bytes, whole texts each, so the
memory of a task does not depend on how many rows a batch has; a single longer
text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2_000_000
# Values that are weighed at once, each a few words of memory.
PIECE = 1 << 17

# The white space between words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def numbered(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd words."""
    with np.errstate(over="ignore"):
        steps = (np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps) | np.uint64(1)


PLACES = 1024
WEIGHT = numbered(PLACES, 1)
FAR_WEIGHT = numbered(PLACES, 2)
FAR_WEIGHT[0] = 1


def utf8(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each starts (one more than there are texts). Null is empty."""
    whole = pc.fill_null(strings.cast(pa.large_string()), "")
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.combine_chunks()
    _, offsets, data = whole.buffers()
    places = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None and places[-1] > places[0] else np.zeros(0, np.uint8)
    return raw, places - places[0]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK, rows: int | None = None
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches, of ``rows`` rows at most, with the bytes and starts of a text column."""
    for batch in batches:
        raw, starts = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + size, "right")) - 1)
            end = min(end, at + rows) if rows else end
            own = starts[at : end + 1]
            yield batch.slice(at, end - at), raw[own[0] : own[-1]], own - own[0]
            at = end


def code_points(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each text starts among them."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return points, heads[starts]


def words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all texts start and end."""
    inner = ~IS_SPACE[raw]
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    opens = inner.copy()
    opens[1:] &= ~inner[:-1] | edge[1:-1]
    closes = inner.copy()
    closes[:-1] &= ~inner[1:] | edge[1:-1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def spread(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... for lengths[0] places, then the same from first[1], ..."""
    ends = np.cumsum(lengths)
    return np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def hashed(values: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of values; no run may be empty.

    Runs of about ``PIECE`` values are taken at a time, so memory grows with the number of runs and the longest of them.
    """
    out = np.zeros(len(first), np.uint64)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(first):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] - lengths[at] + PIECE, "right")))
        out[at:end] = _weighed(values, first[at:end], lengths[at:end])
        at = end
    return out


def _weighed(values: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    with np.errstate(over="ignore"):
        parts = (values[spread(first, lengths)].astype(np.uint64) + np.uint64(1)) * WEIGHT[place % PLACES]
        if int(lengths.max()) > PLACES:
            parts *= FAR_WEIGHT[(place // PLACES) % PLACES]
        return mixed(np.add.reduceat(parts, heads) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def counted(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which text each place belongs to."""
    return np.searchsorted(starts, places, "right") - 1

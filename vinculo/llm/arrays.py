"""Texts as flat numpy arrays: what the Arrow-backed operators share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20  # text handled at once inside a task; a longer text is a chunk of its own

# Separators of words: space and the bytes 0x09 to 0x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

U64 = np.uint64


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(at[0]) if len(at) else 0
    return body[first : int(at[-1]) if len(at) else 0], at.astype(np.int64) - first


def chunked(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows, so that a piece holds at most ``limit`` bytes of ``column`` or one row."""
    for batch in batches:
        _, at = flat(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def word_spans(data: np.ndarray, at: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 offsets of each row's words; words never cross rows."""
    inside = ~separators[data]
    edges = at[:-1][at[1:] > at[:-1]]  # first bytes of the rows that have any
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = at[1:][at[1:] > at[:-1]] - 1
    ends[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finishing steps of splitmix64)."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> U64(27))
    values = values * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@lru_cache(maxsize=2)
def _powers(size: int, inverse: bool) -> np.ndarray:
    steps = np.full(size, _BASE_INVERSE if inverse else BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def powers(count: int, inverse: bool = False) -> np.ndarray:
    """The first ``count`` powers of the hash base (or of its inverse), modulo 2**64."""
    return _powers(1 << max(16, (max(count, 1) - 1).bit_length()), inverse)[:count]


class PrefixHash:
    """Polynomial prefix hashes of a sequence of 64-bit values: the hash of any stretch in constant time."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(len(values)), out=self.sums[1:])
        self.inverse = powers(len(values) + 1, inverse=True)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hashes of the stretches [start, end), comparable across sequences."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


PIECE = 512  # bytes hashed in a row; longer strings are hashed by the hashes of their pieces
_TAILS = np.array([0] + [(1 << 8 * n) - 1 for n in range(1, 9)], dtype=np.uint64)


def _piece_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    state = mixed(sizes.astype(U64) * BASE + U64(seed))
    step = U64(0xD6E8FEB86659FD93 + 2 * seed)
    live, done = np.flatnonzero(sizes > 0), 0
    while len(live):
        left = sizes[live] - done
        taken = eights[starts[live] + done] & _TAILS[np.minimum(left, 8)]
        state[live] = mixed((state[live] ^ taken) * step + BASE)
        live, done = live[left > 8], done + 8
    return state


def string_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte strings [start, end) of ``data``, mixed after every eight bytes.

    Unlike sums of powers, they have no strings that collide whatever the constants. Seeds give independent hashes.
    """
    sizes = ends - starts
    counts = np.maximum(-(-sizes // PIECE), 1)
    if not len(counts) or counts.max() == 1:
        return _piece_hashes(data, starts, sizes, seed)
    owner, first = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
    begin = starts[owner] + ranges(np.zeros(len(counts), np.int64), counts) * PIECE
    pieces = _piece_hashes(data, begin, np.minimum(ends[owner] - begin, PIECE), seed)
    result = pieces[first]
    long = np.flatnonzero(counts > 1)
    result[long] = string_hashes(pieces.view(np.uint8), 8 * first[long], 8 * (first + counts)[long], seed + 1) ^ sizes[long].astype(U64)
    return result


def rows_of(at: np.ndarray) -> np.ndarray:
    """The row of every element, from the n + 1 offsets of the rows."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``count`` numbers each, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shifts = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return shifts + np.arange(total)

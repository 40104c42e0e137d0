"""Blocks of documents and buckets of hashes: how the exact substring operators shuffle.

Documents are dealt to blocks of about ``BLOCK_BYTES`` of text by a hash of their id. A block sends each distinct 64-bit
key once, with what it knows of it, so a passage found in a third of all documents costs an entry per block and not one
per document. Keys travel packed: one row holds all of a block's keys for a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.llm.arrays import flat

BLOCK_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max  # the place of documents without an id: behind all others

PACKED = "bucket int, block int, payload binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])


def in_blocks(docs: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(``block``, ``id``, ``text``) of every row, and the number of blocks; the text bytes are counted beforehand."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-total // block_bytes))
    spread = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id"))  # no common block for null
    return rows.select(F.pmod(spread, F.lit(count)).cast("int").alias("block"), "id", "text"), count


def places(ids: pa.ChunkedArray) -> np.ndarray:
    """The ids as numbers to compare; null is behind all others."""
    return ids.combine_chunks().fill_null(LAST).to_numpy() if ids.null_count else ids.to_numpy()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


_ZSTD = pa.Codec("zstd", compression_level=1)


def press(*columns: np.ndarray) -> bytes:
    """Columns end to end, compressed; bytes of equal weight stand together, so that small numbers take little room."""
    head = np.array([len(columns), *(c.nbytes for c in columns)], dtype=np.int64).tobytes()
    planes = (np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns)
    body = head + b"".join(planes)
    return len(body).to_bytes(8, "little") + _ZSTD.compress(body, asbytes=True)


def unpress(payload: bytes, kinds: list) -> list[np.ndarray]:
    """The columns again, as arrays of the given types."""
    body = _ZSTD.decompress(payload[8:], int.from_bytes(payload[:8], "little"), asbytes=True)
    count = int(np.frombuffer(body, np.int64, 1)[0])
    sizes = np.frombuffer(body, np.int64, count, 8)
    starts = 8 * (count + 1) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
    result = []
    for kind, size, start in zip(kinds, sizes.tolist(), starts.tolist(), strict=True):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8, size, start).reshape(width, -1)
        result.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
    return result


def packed_rows(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    """A table of (bucket, block, payload)."""
    rows = list(rows)
    buckets, blocks, payloads = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(buckets, pa.int32()), pa.array(blocks, pa.int32()), pa.array(payloads, pa.binary())], schema=_PACKED)


def pack(block: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.Table:
    """One row per bucket with the block's entries: 64-bit ``columns``, dealt by ``keys``; the first is sent as differences."""
    bucket = bucket_of(keys, buckets)
    columns = [np.ascontiguousarray(c).view(np.uint64) for c in columns]
    order = np.lexsort((columns[0], bucket))
    columns = [c[order] for c in columns]
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return packed_rows((int(b), block, _steps([c[bounds[b] : bounds[b + 1]] for c in columns])) for b in np.flatnonzero(np.diff(bounds)))


def _steps(columns: list[np.ndarray]) -> bytes:
    return press(np.diff(columns[0], prepend=np.uint64(0)), *columns[1:])


def unpack(table: pa.Table, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The block of every entry, and the ``width`` columns, of all rows of a table of packed entries."""
    parts = [unpress(x, [np.uint64] * width) for x in table.column("payload").to_pylist()]
    sizes = [len(part[0]) for part in parts]
    blocks = np.repeat(table.column("block").to_numpy().astype(np.int32), sizes)
    if not parts:
        return blocks, [np.zeros(0, np.uint64)] * width
    first = np.concatenate([np.cumsum(part[0], dtype=np.uint64) for part in parts])
    return blocks, [first, *(np.concatenate([part[i] for part in parts]) for i in range(1, width))]


def to_blocks(bucket: int, blocks: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """Answers on their way back: one row per block, the first column as differences."""
    columns = [np.ascontiguousarray(c).view(np.uint64) for c in columns]
    order = np.lexsort((columns[0], blocks))
    blocks, columns = blocks[order], [c[order] for c in columns]
    starts = group_starts(blocks)
    ends = np.append(starts, len(blocks))[1:]
    return packed_rows((bucket, int(blocks[a]), _steps([c[a:b] for c in columns])) for a, b in zip(starts, ends, strict=True))


# --- a filter: which codes occur in two documents -----------------------------------------------------

NAME = ~np.uint64(3)  # the two lowest bits of a code are marks
MANY, CROWDED = np.uint64(1), np.uint64(2)  # two documents of the block; very many rows in all
_LOW = np.uint64(0xFFFFFFFF)


def codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket and the lower half of a hash, without marks: what the filter goes by. Nothing is decided by it."""
    return (bucket_of(hashes, buckets).astype(np.uint64) << np.uint64(32)) | (hashes & _LOW & NAME)


def send_codes(block: int, found: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> pa.Table:
    """A block's distinct codes, 32 bits each, from stretches of (code, document); with their number of rows."""
    parts = []
    for code, doc in found:
        order = np.argsort(code, kind="stable")
        code, doc = code[order], doc[order]
        heads = group_starts(code)
        if len(heads):
            counts = np.diff(np.append(heads, len(code)))
            parts.append((code[heads], np.minimum.reduceat(doc, heads), np.maximum.reduceat(doc, heads), counts))
    if not parts:
        return packed_rows(())
    code, first, last, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(code, kind="stable")
    code, first, last, count = code[order], first[order], last[order], count[order]
    heads = group_starts(code)
    many = np.minimum.reduceat(first, heads) < np.maximum.reduceat(last, heads)
    counts = np.minimum(np.add.reduceat(count, heads), 0xFFFF).astype(np.uint16)
    entry = code[heads] | many.astype(np.uint64)
    bounds = np.searchsorted(entry >> np.uint64(32), np.arange(buckets + 1).astype(np.uint64))
    cut = [(b, entry[bounds[b] : bounds[b + 1]].astype(np.uint32), counts[bounds[b] : bounds[b + 1]]) for b in range(buckets)]
    return packed_rows((b, block, press(np.diff(e, prepend=np.uint32(0)), c)) for b, e, c in cut if len(e))


def share_codes(bucket: int, table: pa.Table, hot: int) -> pa.Table:
    """To each block those of its codes that two documents have, marked if there are more than ``hot`` rows of them."""
    parts = [unpress(x, [np.uint32, np.uint16]) for x in table.column("payload").to_pylist()]
    entry = np.concatenate([np.cumsum(steps, dtype=np.uint32) for steps, _ in parts])
    count = np.concatenate([counts for _, counts in parts]).astype(np.int64)
    block = np.repeat(table.column("block").to_numpy(), [len(counts) for _, counts in parts])
    order = np.argsort(entry & ~np.uint32(3), kind="stable")
    entry, count, block = entry[order], count[order], block[order]
    heads = group_starts(entry & ~np.uint32(3))
    total = np.diff(np.append(heads, len(entry)))
    shared = np.repeat((total > 1) | (np.bitwise_or.reduceat(entry & np.uint32(1), heads) > 0), total)
    crowded = np.repeat(np.add.reduceat(count, heads) > hot, total)
    answer = ((entry & ~np.uint32(3)) | (crowded * np.uint32(2)).astype(np.uint32))[shared]
    block = block[shared]
    order = np.lexsort((answer, block))
    answer, block = answer[order], block[order]
    starts = group_starts(block)
    ends = np.append(starts, len(block))[1:]
    return packed_rows((bucket, int(block[a]), press(np.diff(answer[a:b], prepend=np.uint32(0)))) for a, b in zip(starts, ends, strict=True))


def shared_codes(answers: pa.Table) -> np.ndarray:
    """A block's shared codes, sorted, their marks still in them."""
    found = [np.zeros(0, np.uint64)]
    for bucket, payload in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist(), strict=True):
        (steps,) = unpress(payload, [np.uint32])
        found.append(np.cumsum(steps, dtype=np.uint32).astype(np.uint64) | (np.uint64(bucket) << np.uint64(32)))
    return np.sort(np.concatenate(found))


def in_table(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in the sorted table, and where."""
    if not len(table):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in columns that are sorted together."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def pieces(table: pa.Table, limit: int) -> Iterator[pa.Table]:
    """A block's rows in stretches of at most ``limit`` bytes of text, or of one row."""
    _, at = flat(table.column("text"))
    low = 0
    while low < table.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
        yield table.slice(low, high - low)
        low = high

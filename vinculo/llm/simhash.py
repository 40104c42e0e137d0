"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

Fingerprints are 64 bits over word shingles. Equal fingerprints are one node, so copies never meet each other. Nodes
fall into cells by the population counts of their upper and lower halves; two fingerprints within ``radius`` bits lie
in cells whose counts differ by ``radius`` at most in sum, so all other cell pairs are skipped unseen. A cell above
``TILE`` nodes is cut into tiles by hash. Every remaining pair of tiles is one row; a task compares it with
exclusive-or and bit counts, again skipping sub-tiles by the counts of the four quarters, and returns a spanning
forest of the links found, never the links themselves. Spark joins the forests into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.llm.arrays import SPACES, chunked, flat, word_spans
from vinculo.llm.components import components
from vinculo.session import staged

SEED = 42  # of the shingle hash
TILE = 32_768  # fingerprints in a tile: a pair of tiles is half a megabyte
SUBTILE = 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(data: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of ``words`` words (or of all words, if fewer), and the n + 1 offsets of the rows."""
    data = _LOWER[data]
    starts, ends, bounds = word_spans(data, at)
    joined = np.full(int((ends - starts).sum()) + len(starts), 0x20, dtype=np.uint8)  # one space after each word
    lengths = ends - starts
    to = np.concatenate(([0], np.cumsum(lengths + 1)))
    inside = ~SPACES[data]
    places = np.ones(len(joined), dtype=bool)
    places[to[1:] - 1] = False
    joined[places] = data[inside]
    counts = np.diff(bounds)
    shingles = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    offsets = np.concatenate(([0], np.cumsum(shingles)))
    first = np.repeat(bounds[:-1] - offsets[:-1], shingles) + np.arange(offsets[-1])
    last = np.minimum(first + words, np.repeat(bounds[1:], shingles))
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(to[first].tolist(), (to[last] - 1).tolist(), strict=True)]
    return np.array(hashes, dtype=np.uint64), offsets


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row the bits set in over half of its hashes; a row without hashes gives zero."""
    counts = np.diff(offsets)
    full = np.flatnonzero(counts)
    result = np.zeros(len(counts), dtype=np.uint64)
    if not len(full):
        return result
    # Eight counters of eight bits in a word: stretches of 255 hashes cannot overflow them.
    pieces = -(-counts[full] // 255)
    piece_at = np.concatenate(([0], np.cumsum(pieces)))
    cuts = np.repeat(offsets[:-1][full], pieces) + 255 * (np.arange(piece_at[-1]) - np.repeat(piece_at[:-1], pieces))
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _BYTE_LANES, cuts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), piece_at[:-1], axis=0)
        set_bits = 2 * sums > counts[full][:, None]
        for lane in range(8):
            result[full] |= set_bits[:, lane].astype(np.uint64) << np.uint64(8 * lane + shift)
    return result


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (id, ``bits`` long) for every row of ``docs``; a null text has no words and gives zero."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "t"):
            bits = majority(*shingle_hashes(*flat(part.column("t")), shingle))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(bits.view(np.int64))], names=["id", "bits"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t")).mapInArrow(of, f"id {kind}, bits bigint")


def _quarters(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits.view(np.uint16).reshape(-1, 4)).astype(np.int64)


def _subtiles(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order by quarter counts, the cuts, and each sub-tile's least and greatest counts."""
    counts = _quarters(bits)
    order = np.lexsort((counts[:, 2], counts[:, 0], counts[:, 3] + counts[:, 2]))
    cuts = np.arange(0, len(bits), SUBTILE)
    sorted_counts = counts[order]
    return order, cuts, np.minimum.reduceat(sorted_counts, cuts), np.maximum.reduceat(sorted_counts, cuts)


def _forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (node, root) that connect what the links within ``radius`` connect; ``right`` None: within ``left``."""
    a_order, a_cuts, a_low, a_high = _subtiles(left)
    nodes = left[a_order]
    if right is None:
        b_cuts, b_low, b_high, shift = a_cuts, a_low, a_high, 0
    else:
        b_order, b_cuts, b_low, b_high = _subtiles(right)
        nodes, shift = np.concatenate((nodes, right[b_order])), len(left)
    size_b = len(left) if right is None else len(right)
    label = np.arange(len(nodes))
    for i, a in enumerate(a_cuts):
        gap = np.maximum(np.maximum(b_low - a_high[i], a_low[i] - b_high), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        rows = nodes[a : min(a + SUBTILE, len(left)), None]
        for j in near[near >= i] if right is None else near:
            b = b_cuts[j]
            columns = nodes[shift + b : shift + min(b + SUBTILE, size_b)]
            close = np.bitwise_count(rows ^ columns) <= radius
            x, y = np.nonzero(close)
            x, y = x + a, y + b + shift
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            while len(x):  # join the roots of the new links until none is left
                p, q = label[x], label[y]
                low = np.minimum(p, q)
                np.minimum.at(label, p, low)
                np.minimum.at(label, q, low)
                while not np.array_equal(label, up := label[label]):
                    label = up
                apart = label[x] != label[y]
                x, y = x[apart], y[apart]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return nodes[moved], nodes[label[moved]]


def _tiles(nodes: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """One row per tile with its fingerprints packed, and the number of tiles of each cell (at most 33 x 33 rows)."""
    high, low = F.bit_count(F.shiftrightunsigned("bits", 32)), F.bit_count(F.col("bits").bitwiseAND(0xFFFFFFFF))
    nodes = nodes.select("bits", high.cast("int").alias("high"), low.cast("int").alias("low"))
    cells = nodes.groupBy("high", "low").agg(F.ceil(F.count("*") / tile).cast("int").alias("pieces"))
    placed = nodes.join(F.broadcast(cells), ["high", "low"]).withColumn("piece", F.pmod(F.xxhash64("bits"), "pieces").cast("int"))

    def pack(key, table):
        bits = np.sort(table.column("bits").to_numpy())
        row = [[key[0].as_py()], [key[1].as_py()], [key[2].as_py()], [bits.tobytes()]]
        return pa.table([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["high", "low", "piece", "packed"])

    packed = placed.groupBy("high", "low", "piece").applyInArrow(pack, "high int, low int, piece int, packed binary")
    return packed, cells


def fingerprint_links(nodes: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Links (u, v) of distinct fingerprints (column ``bits``) that connect all within ``radius`` bits of each other."""
    tiles, cells = _tiles(nodes, tile)
    tiles = staged(tiles, "tiles")
    steps = [(i, j) for i in range(radius + 1) for j in range(-radius, radius + 1) if i + abs(j) <= radius and (i, j) >= (0, 0)]
    step = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps)))
    left = tiles.withColumn("step", step).select(
        "high", "low", "piece", "packed", (F.col("high") + F.col("step.i")).alias("high2"), (F.col("low") + F.col("step.j")).alias("low2")
    )
    others = cells.select(F.col("high").alias("high2"), F.col("low").alias("low2"), "pieces")
    same = (F.col("high") == F.col("high2")) & (F.col("low") == F.col("low2"))
    left = left.join(F.broadcast(others), ["high2", "low2"]).withColumn("piece2", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    left = left.where(~same | (F.col("piece") <= F.col("piece2")))
    right = tiles.select(F.col("high").alias("high2"), F.col("low").alias("low2"), F.col("piece").alias("piece2"), F.col("packed").alias("packed2"))
    pairs = left.join(right, ["high2", "low2", "piece2"])
    pairs = pairs.select("packed", F.when(~(same & (F.col("piece") == F.col("piece2"))), F.col("packed2")).alias("packed2"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column(0), batch.column(1), strict=True):
                a = np.frombuffer(one.as_py(), dtype=np.uint64)
                u, v = _forest(a, None if not two.is_valid else np.frombuffer(two.as_py(), dtype=np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return pairs.mapInArrow(compare, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_column: str = "doc_id", text_column: str = "text", tile: int = TILE
) -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``): the least id reachable over fingerprints at most ``radius`` bits apart.

    Nulls and empty texts have fingerprint zero and link like any other. Repeated rows stay repeated. A row with a null
    id gets its component like any other but never names one; a component of such rows alone has a null name. An empty
    table gives an empty result; other columns of ``docs`` are ignored.
    """
    prints = staged(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    nodes = prints.groupBy("bits").agg(F.min("id").alias("least"))
    roots = components(fingerprint_links(nodes, radius, tile))
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("root")
    )
    placed = staged(placed, "nodes")
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("bits", "component_id")
    # An unlinked fingerprint's component is known from its own rows; only the join below touches rows.
    return prints.join(named, "bits").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the least id.

    Rows sharing that id are all kept (they are one document); rows with a null id cannot be told apart and stay.
    """
    groups = near_duplicates(docs, shingle, radius, id_column, text_column)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(id_column)).distinct()
    return docs.join(gone, id_column, "left_anti")

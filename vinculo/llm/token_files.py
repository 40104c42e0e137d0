"""Token ids of documents in range-coded block files, in order of their ids.

A token folder holds two tables. ``frames`` has one row per frame: part, number within the part, number of ids, and the
frame itself, a self-contained binary of a few million ids of whole documents. ``starts`` has one row per part: the ids
before it. Parts follow the order of the document ids, and so do frames within a part.

A frame (little-endian): magic ``VTF2``; the number of sections and the bytes of each; then, compressed with Zstandard, the
document ids, which of them are null, and their numbers of ids; the blocks' numbers of ids, word counts and CRC-32
checksums; the frame's alphabet as differences, and how often each of its ids occurs; and the range-coded words. A block
codes ``BLOCK`` ids from a fresh state (see :mod:`vinculo.llm.range_coder`), and is checked against its checksum when read.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculo.llm import range_coder
from vinculo.llm.arrays import chunked, flat, ranges
from vinculo.llm.bpe import PLAIN

MAGIC = b"VTF2"
FRAME_IDS = 7_000_000
COUNTED = 1 << 22  # ids below it are counted in a table, others are sorted
TEXT_BYTES = 4 << 20  # text encoded at once
KNOWN_WORDS = 1_500_000  # words a worker keeps, some 100 MB with their ids; then it starts anew
PART_BYTES = 16 << 20  # text of a part

FRAMES = "part int, frame int, n_docs bigint, n_ids bigint, body binary"
DOCUMENTS = "doc_id bigint, part int, frame int, place int, n_tokens bigint, ids_crc32 bigint"


# --- tokens -------------------------------------------------------------------------------------------


_SPACE, _LETTER, _NUMBER, _OTHER, _UNUSUAL = range(5)


def _kinds() -> np.ndarray:
    """The kind of each code point up to the last plain one, and of all others, in byte-level vocabularies' pattern."""
    kinds = np.full(ord(PLAIN[-1]) + 2, _UNUSUAL, np.uint8)
    for char in PLAIN:
        kinds[ord(char)] = _SPACE if char.isspace() else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(char)[0], _OTHER)
    return kinds


def word_starts(codes: np.ndarray, kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the pattern of byte-level vocabularies starts a word, for texts of code points that start at ``firsts``.

    The pattern (fixed value): ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+``. Words cover each text.
    """
    size = len(codes)
    first = np.zeros(size + 1, bool)
    first[firsts] = True  # an empty last text starts behind the end
    space = kinds == _SPACE
    starts = first[:size].copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    # The last of some white space before a word stands apart, and a blank there is part of the word.
    last = space.copy()
    last[:-1] &= ~space[1:]
    last[-1:] = False
    last &= ~first[1:]
    starts |= last
    led = np.flatnonzero(last & (codes == 0x20)) + 1
    starts[led] = False
    # Contractions: an apostrophe that starts a word, with one or two letters; the word after them starts anew.
    marks = np.flatnonzero(starts & (codes == 0x27))
    bounds = np.append(firsts, size)
    room = bounds[np.searchsorted(bounds, marks, side="right")] - marks
    padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
    one, two = padded[marks + 1], padded[marks + 2]
    short = np.isin(one, [ord(c) for c in "stmd"]) & (room > 1)
    long = np.zeros(len(marks), bool)
    for pair in ("re", "ve", "ll"):
        long |= (one == ord(pair[0])) & (two == ord(pair[1])) & (room > 2)
    starts[marks[short | long] + 1] = False
    ends = np.concatenate((marks[short] + 2, marks[long] + 3))
    starts[ends[ends < size]] = True
    return np.flatnonzero(starts)


class Tokens:
    """Encodes texts with the tokenizers library, each distinct word once.

    A byte-level vocabulary splits a text by its pattern before any merge, so a word's ids are the same wherever it
    stands. Texts with special tokens, or with characters that two pattern engines could class differently, go to the
    library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.kinds = _kinds()
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())  # words, each once
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # the ids of the words, end to end

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [row.ids for row in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        at = np.cumsum([0, *map(len, rows)])
        return np.fromiter(chain.from_iterable(rows), np.uint32, int(at[-1])), at

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """The places of distinct words among the known ones, once they are all known."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        place = pc.index_in(words, value_set=self.known)
        fresh = words.filter(place.is_null())
        result = place.fill_null(0).to_numpy().astype(np.int64)
        if len(fresh):
            result[place.is_null().to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(fresh))
            ids, at = self._library(fresh.to_pylist())
            self.known = pa.concat_arrays([self.known, fresh])
            self.ids, self.at = np.concatenate((self.ids, ids)), np.concatenate((self.at, self.at[-1] + at[1:]))
        return result

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, end to end, and the n + 1 offsets of each text's; null has none."""
        data, at = flat(texts)
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        kinds = self.kinds.take(codes, mode="clip")
        plain = len(codes) == len(data)  # a byte for every character
        bytes_at = at if plain else np.concatenate(([0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))))
        firsts = at if plain else np.searchsorted(bytes_at, at)
        # Texts for the library are left out here, and put in below.
        row = np.searchsorted(firsts, np.flatnonzero(kinds == _UNUSUAL), side="right") - 1
        whole = np.zeros(len(at) - 1, bool)
        whole[row] = True
        body = data.tobytes()
        if any(token.encode() in body for token in self.special):
            parts = [body[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            whole |= np.array([any(token.encode() in part for token in self.special) for part in parts])
        starts = word_starts(codes, kinds, firsts[:-1])
        cuts = np.append(starts if plain else bytes_at[starts], len(data))
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(body))
        if whole.any():
            per_row = np.searchsorted(starts, firsts)
            words = words.filter(pa.array(~np.repeat(whole, np.diff(per_row))))
        coded = words.dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy()]
        sizes = self.at[place + 1] - self.at[place]
        ids = self.ids[ranges(self.at[place], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        if not whole.any():
            return ids, ends[np.searchsorted(starts, firsts)]
        of_row = np.where(whole, 0, np.diff(per_row))
        by_words = np.diff(ends[np.concatenate(([0], np.cumsum(of_row)))])
        own, own_at = self._library([body[at[i] : at[i + 1]].decode() for i in np.flatnonzero(whole).tolist()])
        counts = by_words
        counts[whole] = np.diff(own_at)
        result = np.empty(int(counts.sum()), np.uint32)
        from_library = np.repeat(whole, counts)
        result[from_library], result[~from_library] = own, ids
        return result, np.concatenate(([0], np.cumsum(counts)))

    def __call__(self, texts: list[str | None]) -> list[list[int]]:
        ids, at = self.encode(pa.array(texts, pa.string()))
        return [ids[a:b].tolist() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def tokens_for(path: str) -> Tokens:
    return Tokens(path)


# --- frames -------------------------------------------------------------------------------------------

_ZSTD = pa.Codec("zstd", compression_level=1)


def _section(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct ids, how often each occurs, and the places of all ids, from 1."""
    if not len(ids) or ids.max() >= COUNTED:
        letters, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
        return letters, counts, (place + 1).astype(np.uint32)
    counts = np.bincount(ids)
    letters = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.uint32)
    place[letters] = np.arange(1, len(letters) + 1)
    return letters, counts[letters], place[ids]


def write_frame(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The frame of some documents' ids."""
    flat_ids = np.concatenate([np.zeros(0, np.uint32), *ids]).astype("<u4")
    cuts = np.arange(0, len(flat_ids), range_coder.BLOCK)
    lengths = np.diff(np.append(cuts, len(flat_ids)))  # only the last can be shorter
    letters, often, place = _alphabet(flat_ids)
    places = np.zeros((len(cuts), range_coder.BLOCK), np.uint32)
    places.reshape(-1)[: len(flat_ids)] = place
    words = range_coder.encode(places, lengths, np.full(len(cuts), len(letters)), range_coder.shares(often)) if len(cuts) else []
    checks = np.array([zlib.crc32(flat_ids[a : a + range_coder.BLOCK].tobytes()) for a in cuts], "<u4")
    sections = [
        np.array([x if x is not None else 0 for x in doc_ids], "<i8"),
        np.array([x is None for x in doc_ids], "u1"),
        np.array([len(x) for x in ids], "<i8"),
        lengths.astype("<u4"),
        np.array([len(w) for w in words], "<u4"),
        checks,
        np.diff(letters.astype(np.int64), prepend=0).astype("<u4"),
        often.astype("<i8"),
        np.concatenate([np.zeros(0, np.uint32), *words]).astype("<u4"),
    ]
    packed = [_section(x) for x in sections]
    head = np.array([len(packed), *map(len, packed)], "<i8").tobytes()
    return MAGIC + head + b"".join(packed)


_KINDS = ("<i8", "u1", "<i8", "<u4", "<u4", "<u4", "<u4", "<i8", "<u4")


def read_frame(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The documents of a frame, the n + 1 offsets of their ids, and the ids; fails on a block that does not check."""
    if body[:4] != MAGIC:
        raise ValueError("not a token frame")
    count = int(np.frombuffer(body, "<i8", 1, 4)[0])
    sizes = np.frombuffer(body, "<i8", count, 12)
    at = 12 + 8 * count + np.concatenate(([0], np.cumsum(sizes)))
    sections = []
    for kind, low, high in zip(_KINDS, at[:-1].tolist(), at[1:].tolist(), strict=True):
        raw = _ZSTD.decompress(body[low + 8 : high], int.from_bytes(body[low : low + 8], "little"), asbytes=True)
        sections.append(np.frombuffer(raw, kind))
    docs, nulls, counts, lengths, used, checks, steps, often, words = sections
    offsets = np.concatenate(([0], np.cumsum(counts)))
    ids = np.zeros(0, "<u4")
    if len(lengths):
        ends = np.cumsum(used.astype(np.int64))
        lengths = lengths.astype(np.int64)
        blocks = [words[e - u : e] for e, u in zip(ends, used.astype(np.int64), strict=True)]
        places = range_coder.decode(blocks, lengths, np.full(len(lengths), len(often)), range_coder.shares(often))
        letters = np.cumsum(steps.astype(np.int64)).astype("<u4")
        # Blocks are full but for the last one.
        ids = letters[places.reshape(-1)[: int(lengths.sum())].astype(np.int64) - 1]
    bad = [i for i, low in enumerate(range(0, len(ids), range_coder.BLOCK)) if zlib.crc32(ids[low : low + range_coder.BLOCK].tobytes()) != checks[i]]
    if bad or len(ids) != offsets[-1]:
        raise ValueError(f"blocks {bad[:5]} of a token frame are damaged")
    names = [None if null else int(doc) for doc, null in zip(docs, nulls, strict=True)]
    return names, offsets, ids


# --- folders ------------------------------------------------------------------------------------------


def write_tokens(docs: DataFrame, folder: str, path: str, end: int | None = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every text and write ``folder``, which must not exist.

    ``end`` is appended to each document's ids. Null and empty texts have no other ids. Documents stand in ascending order
    of id, null first, rows of one id by text; repeated rows stay repeated; other columns are ignored. An empty table
    writes an empty folder. Integer ids. ``path`` is a byte-level vocabulary file of the tokenizers library.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("t"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    parts = max(1, -(-total // PART_BYTES))
    ordered = rows.repartitionByRange(parts, "id", F.xxhash64("t")).sortWithinPartitions("id", "t")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = tokens_for(path), TaskContext.get().partitionId(), 0
        tail = np.array([] if end is None else [end], np.uint32)
        names: list[int | None] = []
        ids: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            row = [[part], [number], [len(ids)], [sum(map(len, ids))], [write_frame(names, ids)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["part", "frame", "n_docs", "n_ids", "body"])

        held = 0
        for piece in chunked(batches, "t", TEXT_BYTES):
            found, at = encoder.encode(piece.column("t"))
            for name, low, high in zip(piece.column("id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = found[low:high]
                if held and held + len(own) >= FRAME_IDS:
                    yield out()
                    number, names, ids, held = number + 1, [], [], 0
                names.append(name)
                ids.append(np.concatenate((own, tail)))
                held += len(own) + len(tail)
        if names:
            yield out()

    ordered.mapInArrow(frames, FRAMES).write.parquet(f"{folder}/frames")
    spark = docs.sparkSession
    sizes = spark.read.schema(FRAMES).parquet(f"{folder}/frames").groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part")
    starts, before = [], 0
    for row in sizes.collect():  # one row per part
        starts.append((row["part"], before))
        before += row["n"]
    spark.createDataFrame(starts, "part int, start bigint").coalesce(1).write.parquet(f"{folder}/starts")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``) of every document, from its decoded ids.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over its ids as little-endian 32-bit integers.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, frame, body in zip(*(batch.column(n) for n in ("part", "frame", "body")), strict=True):
                names, offsets, ids = read_frame(body.as_py())
                checks = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                size = len(names)
                columns = [
                    pa.array(names, pa.int64()),
                    pa.array([part.as_py()] * size, pa.int32()),
                    pa.array([frame.as_py()] * size, pa.int32()),
                    pa.array(offsets[:-1], pa.int64()),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(checks, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "frame", "place", "n_tokens", "ids_crc32"])

    frames = spark.read.schema(FRAMES).parquet(f"{folder}/frames")
    read = frames.select("part", "frame", "body").mapInArrow(of, DOCUMENTS.replace("place int", "place bigint"))
    # The ids before a frame: those of the parts before, and of the frames before it in its part (a few per part).
    sizes = frames.select("part", "frame", "n_ids")
    earlier = sizes.select(F.col("part").alias("own"), F.col("frame").alias("other"), F.col("n_ids").alias("n"))
    within = sizes.join(earlier, (F.col("part") == F.col("own")) & (F.col("other") < F.col("frame")), "left")
    within = within.groupBy("part", "frame").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("before"))
    starts = spark.read.schema("part int, start bigint").parquet(f"{folder}/starts")
    bases = within.join(starts, "part").select("part", "frame", (F.col("start") + F.col("before")).alias("base"))
    return read.join(bases, ["part", "frame"]).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(``doc_id``, ``ids``) of every document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                names, offsets, ids = read_frame(body.as_py())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists], names=["doc_id", "ids"])

    frames = spark.read.schema(FRAMES).parquet(f"{folder}/frames")
    return frames.select("body").mapInArrow(of, "doc_id bigint, ids array<int>")

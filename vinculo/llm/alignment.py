"""Alignment of two tokenizers' tokens, and how often their ids stand for the same bytes.

Both tokenizers cut the same bytes: a space and the text. Two tokens are linked where their byte ranges overlap; a group
ends wherever a token of either side ends on the same byte. Groups are found by pointer jumping: every token points to
the token that reaches farthest right among those it overlaps and itself, and squaring the pointers until they stand
still leads each token to the last one of its group. All texts of a piece jump together, as flat arrays.

Neither vocabulary merges across certain places (before white space, and between a letter and punctuation), so a text
falls into stretches that are tokenized and aligned once each and looked up afterwards. Whether the vocabularies allow
that is read off them; where they do not, a text is one stretch.

Pair counts are a Spark aggregation. A task writes a block for every few megabytes of text: the documents' own figures,
the block's distinct pairs, and each document's pairs as places in that list. Pairs are added up over all blocks, and
a block gets the totals of its own pairs back, so no table of pairs is broadcast or collected, at any size.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vinculo.llm.arrays import chunked, ranges, rows_of
from vinculo.llm.bpe import PLAIN, _byte_letters
from vinculo.llm.exchange import press, unpress
from vinculo.session import staged

TOGETHER = 2_000  # stretches encoded in one go
REMEMBERED = 500_000  # stretches a worker keeps; beyond, it starts anew, which changes no result
BLOCK_BYTES = 8 << 20  # text of a block

CUTS = "\t\n\x0b\x0c "  # white space before which a text may be cut
# What some engine takes for white space besides: a text is not cut behind it.
DOUBTFUL = "".join(map(chr, [13, *range(28, 32), 133, 160, 5760, 6158, *range(8192, 8208), *range(8232, 8240), *range(8287, 8293), 12288, 65279]))
PUNCTUATION = "!-&(-/:-@\\[-`{-~"  # ASCII, without the apostrophe: contractions are words of a byte-level pattern


class Sides:
    """The two tokenizers: ids, and the bytes behind every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: byte for byte, letter in enumerate(_byte_letters())}
        spelt = {n: bytes(map(byte_of.__getitem__, token)) for token, n in spec["model"]["vocab"].items() if set(token) <= byte_of.keys()}
        spelt |= {item["id"]: item["content"].encode() for item in spec["added_tokens"]}
        self.bytes_a = _Spelling([spelt.get(n, b"") for n in range(max(spelt) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        single = [self.b.is_byte(n) for n in range(len(pieces))]
        self.bytes_b = _Spelling(
            [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in zip(pieces, single, strict=True)]
        )
        self.space = self.b.piece_to_id("▁")
        decimal = [str(n) for x in (self.bytes_a, self.bytes_b) for n in range(len(x.sizes))]
        self.spoken, self.written = len(decimal), [n + mark for mark in ",|;\n" for n in decimal]
        self._places([p for p, byte in zip(pieces, single, strict=True) if not byte])

    def _places(self, pieces: list[str]) -> None:
        """Where texts may be cut, as patterns; None if the pieces of B do not allow it."""
        met = {x + y for p in pieces for x, y in pairwise(p.replace("▁", " "))}
        white = all(x[1] not in CUTS or x == "  " for x in met) and not any(x[0] in CUTS[:-1] for x in met)
        self.words = self.apart = None
        if not white:
            return
        letters = "".join(c for c in PLAIN if c.isalpha())
        blank = re.escape(CUTS)
        word = f"[{re.escape(CUTS[:-1])}](?=[^{blank}])|[{blank}]*[^{blank}]+|[{blank}]+"  # a lone line break stands for itself
        if not any(x[0].isalpha() and re.match(f"[{PUNCTUATION}]", x[1]) for x in met):
            word = f"[{blank}]*[{re.escape(letters)}]+(?=[{PUNCTUATION}])|" + word
        self.words = re.compile(word).findall
        self.doubtful = re.compile(f"[{DOUBTFUL}]").search
        self.plain = re.compile(f" ?[^{blank}{DOUBTFUL}]+").fullmatch
        self.apart = re.compile(f"(?<=[^{blank}{DOUBTFUL}])(?=[{blank}])").split

    def stretches(self, text: str) -> list[str]:
        """A space and the text, cut where neither tokenizer merges."""
        text = " " + text
        if self.words is None:
            return [text]
        return self.apart(text) if self.doubtful(text) else self.words(text)

    def tokens_a(self, stretches: list[str]) -> list[list[int]]:
        return self._told(stretches, self._encode_a, self._encode_a("\n")[-1], self._encode_a)

    def _encode_a(self, text: str) -> list[int]:
        return self.a.encode(text, add_special_tokens=False).ids

    def tokens_b(self, stretches: list[str]) -> list[list[int]]:
        """B puts a space before what it encodes; a stretch without one follows a line break, and both are dropped."""

        def alone(text: str) -> list[int]:
            return (self.b.encode(text[1:]) or [self.space]) if text[0] == " " else self.b.encode("\n" + text)[2:]

        return self._told(stretches, lambda text: self.b.encode("\n" + text)[2:], self.b.encode("\n")[-1], alone)

    def _told(self, stretches: list[str], encode: Callable, line_break: int, alone: Callable) -> list[list[int]]:
        """Tokens of every stretch. Those without white space inside are encoded many at a time, a line break between two:
        neither vocabulary merges across it."""
        if self.words is None:
            return list(map(alone, stretches))
        plain = [i for i, s in enumerate(stretches) if self.plain(s)]
        result: list[list[int]] = [[]] * len(stretches)
        for low in range(0, len(plain), TOGETHER):
            some = plain[low : low + TOGETHER]
            ids = encode("\n".join([stretches[i] for i in some]))
            cuts = np.flatnonzero(np.array(ids) == line_break).tolist()
            if len(cuts) != len(some) - 1:
                raise ValueError("a vocabulary merges line breaks")
            for i, x, y in zip(some, [-1, *cuts], [*cuts, len(ids)], strict=True):
                result[i] = ids[x + 1 : y]
        for i in set(range(len(stretches))).difference(plain):
            result[i] = alone(stretches[i])
        return result


class _Spelling:
    """The bytes of every id, end to end."""

    def __init__(self, spelt: list[bytes]):
        self.body = np.frombuffer(b"".join(spelt), np.uint8)
        self.sizes = np.array(list(map(len, spelt)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.body[ranges(self.starts[ids], self.sizes[ids])]


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


# --- pointer jumping ----------------------------------------------------------------------------------


def last_of_group(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token of A, then every token of B, the B token that ends its group.

    ``ends`` are increasing byte offsets over the same bytes. Of the tokens that overlap it and itself a token points to
    the one that ends last, to that of B if two end together.
    """
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    own = np.arange(len(ends_b)) + len(ends_a)
    farther = ends_a[over_b] > ends_b if len(ends_a) else np.zeros(len(ends_b), bool)
    points = np.concatenate((over_a + len(ends_a), np.where(farther, over_b, own)))
    while True:
        jumped = points[points]
        if np.array_equal(jumped, points):
            return points - len(ends_a)
        points = jumped


class Aligned:
    """The alignment of a list of stretches: flat ids of both sides, links, groups."""

    def __init__(self, stretches: list[str], both: Sides):
        a, b = both.tokens_a(stretches), both.tokens_b(stretches)
        raw = [s.encode() for s in stretches]
        a, b, self.bad = self._checked(a, b, raw, both)
        count_a, count_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        self.ids_a, self.ids_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, count_a), (b, count_b)))
        self.at_a, self.at_b = (np.concatenate(([0], np.cumsum(n))) for n in (count_a, count_b))
        ends_a, ends_b = np.cumsum(both.bytes_a.sizes[self.ids_a]), np.cumsum(both.bytes_b.sizes[self.ids_b])
        # Every stretch ends on both sides, so that no group and no link leaves one.
        lasts = last_of_group(ends_a, ends_b)
        self.last_a, self.last_b = lasts[: len(ends_a)], lasts[len(ends_a) :]
        first = np.searchsorted(ends_b, ends_a - both.bytes_a.sizes[self.ids_a], side="right")
        fan = np.searchsorted(ends_b, ends_a) - first + 1
        self.link_a, self.link_b = self.ids_a[rows_of(np.concatenate(([0], np.cumsum(fan))))], self.ids_b[ranges(first, fan)]
        self.at_link = np.concatenate(([0], np.cumsum(fan)))[self.at_a]
        self.spelt = self._spelt(both)

    @staticmethod
    def _checked(a: list, b: list, raw: list[bytes], both: Sides) -> tuple[list, list, np.ndarray]:
        """Stretches whose joined bytes differ from the text lose their tokens."""
        bad = np.zeros(len(raw), bool)
        for side, spelling in ((a, both.bytes_a), (b, both.bytes_b)):
            sizes = np.array(list(map(len, side)), np.int64)
            ids = np.fromiter(chain.from_iterable(side), np.int64, int(sizes.sum()))
            lengths = np.concatenate(([0], np.cumsum(spelling.sizes[ids])))[np.concatenate(([0], np.cumsum(sizes)))]
            found = spelling.bytes_of(ids)
            if np.array_equal(np.diff(lengths), np.array(list(map(len, raw)), np.int64)) and found.tobytes() == b"".join(raw):
                continue
            for i, (low, high) in enumerate(pairwise(lengths.tolist())):
                bad[i] |= found[low:high].tobytes() != raw[i]
        for i in np.flatnonzero(bad).tolist():
            a[i], b[i] = [], []
        return a, b, bad

    def _spelt(self, both: Sides) -> list[str]:
        """Each stretch's groups, as ``a1,a2|b1;a3|b2``: all tokens in order of group and side, each with what follows it."""
        ends = np.flatnonzero(self.last_b == np.arange(len(self.last_b)))  # the last B token of each group
        up_to_a, up_to_b = np.searchsorted(self.last_a, ends, side="right"), ends + 1
        self.at_group = np.searchsorted(ends, self.at_b)
        group_a, group_b = np.searchsorted(ends, self.last_a), np.searchsorted(ends, self.last_b)
        place_a = np.arange(len(self.ids_a)) + np.concatenate(([0], up_to_b))[group_a]
        place_b = np.arange(len(self.ids_b)) + up_to_a[group_b]
        mark_a = np.zeros(len(place_a), np.int64)
        mark_a[up_to_a - 1] = 1
        mark_b = np.zeros(len(place_b), np.int64)
        mark_b[ends] = 2
        whole = ~self.bad
        mark_b[self.at_b[1:][whole] - 1] = 3
        size_a = len(both.bytes_a.sizes)
        written = np.zeros(len(place_a) + len(place_b), np.int64)
        written[place_a] = mark_a * both.spoken + self.ids_a
        written[place_b] = mark_b * both.spoken + self.ids_b + size_a
        lines = iter("".join(map(both.written.__getitem__, written.tolist())).split("\n"))
        return [next(lines) if good else "" for good in whole.tolist()]


class Lexicon:
    """Stretches met so far, by number: their figures, their links, their groups in writing."""

    def __init__(self, both: Sides):
        self.both, self.shift = both, len(both.bytes_b.sizes).bit_length()
        self.bits = np.uint64(self.shift + len(both.bytes_a.sizes).bit_length())  # of a pair
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.spelt: list[str] = []
        self.figures = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.bad = np.zeros(0, bool)
        self.links = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def learn(self, stretches: set[str]) -> None:
        if len(self.number) > REMEMBERED:
            self.clear()
        fresh = [s for s in stretches if s not in self.number]
        if not fresh:
            return
        found = Aligned(fresh, self.both)
        for s in fresh:
            self.number[s] = len(self.number)
        self.spelt += found.spelt
        columns = [np.diff(x) for x in (found.at_a, found.at_b, found.at_group, found.at_link)]
        self.figures = np.concatenate((self.figures, np.stack(columns, axis=1)))
        self.bad = np.concatenate((self.bad, found.bad))
        self.starts = np.concatenate((self.starts, found.at_link[:-1] + len(self.links)))
        self.links = np.concatenate((self.links, found.link_a << self.shift | found.link_b))


@lru_cache(maxsize=2)
def lexicon_for(path_a: str, path_b: str) -> Lexicon:
    """One lexicon for all tasks that a Python worker runs in turn."""
    return Lexicon(sides(path_a, path_b))


class Piece:
    """Some texts through the lexicon: figures and groups of each, and its distinct pairs with their numbers of links."""

    def __init__(self, texts: list[str | None], lexicon: Lexicon):
        split = [lexicon.both.stretches(text) if text else [] for text in texts]
        lexicon.learn(set(chain.from_iterable(split)))
        number = lexicon.number.__getitem__
        numbers = [np.fromiter(map(number, s), np.int64, len(s)) for s in split]
        numbers = [own[:0] if lexicon.bad[own].any() else own for own in numbers]
        at = np.concatenate(([0], np.cumsum(list(map(len, numbers))))).astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *numbers])
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(lexicon.figures[flat], axis=0)))
        self.figures = sums[at[1:]] - sums[at[:-1]]
        spelt = lexicon.spelt.__getitem__
        self.spelt = [";".join(map(spelt, own.tolist())) for own in numbers]
        fan = lexicon.figures[flat, 3]
        pairs = lexicon.links[ranges(lexicon.starts[flat], fan)]
        docs = np.repeat(rows_of(at), fan)
        bits = lexicon.bits
        keys, self.links = np.unique(docs.astype(np.uint64) << bits | pairs.astype(np.uint64), return_counts=True)
        self.doc = (keys >> bits).astype(np.int64)
        self.pair = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


# --- Spark --------------------------------------------------------------------------------------------

_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``) for every row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: decimal ids of A, then of B, in order. Whole texts. A text that is null, empty, or
    not spelt back by both tokenizers has no tokens: zeros and an empty string. Strings of special tokens are plain text.
    Rows are mapped one by one: null and repeated ids stay, other columns are ignored, an empty table stays empty.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_for(path_a, path_b)
        for part in chunked(batches, "t"):
            piece = Piece(part.column("t").to_pylist(), lexicon)
            columns = [part.column("id"), *map(pa.array, piece.figures.T.copy()), pa.array(piece.spelt, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *_FIGURES, "groups"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    schema = f"id {kind}, {', '.join(f'{n} bigint' for n in _FIGURES)}, groups string"
    return rows.mapInArrow(of, schema).withColumnRenamed("id", id_column)


def _blocks(docs: DataFrame, path_a: str, path_b: str, id_column: str, text_column: str, block_bytes: int) -> DataFrame:
    """One row per block: (``part``, ``block``, ``docs``, ``pairs``, ``links``), written to the shared folder.

    ``pairs`` holds the block's distinct pairs and their numbers of links; ``links`` how many pairs each document has,
    their places in that list, and their numbers of links.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, part, block = lexicon_for(path_a, path_b), TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, Piece]] = []
        weight = 0

        def out() -> pa.RecordBatch:
            names = pa.concat_arrays([ids for ids, _ in held])
            figures = np.concatenate([p.figures for _, p in held])
            shas = [hashlib.sha256(s.encode()).hexdigest() if s else "" for _, p in held for s in p.spelt]
            rows = pa.StructArray.from_arrays([names, *map(pa.array, figures.T.copy()), pa.array(shas, pa.string())], names=["id", *_FIGURES, "sha"])
            distinct, place = np.unique(np.concatenate([p.pair for _, p in held]), return_inverse=True)
            links = np.concatenate([p.links for _, p in held]).astype(np.int32)
            total = np.bincount(place, weights=links, minlength=len(distinct)).astype(np.int64)
            per_doc = np.concatenate([np.bincount(p.doc, minlength=len(p.figures)) for _, p in held]).astype(np.int32)
            steps = np.diff(place.astype(np.int32), prepend=np.int32(0))
            columns = [
                pa.array([part], pa.int32()),
                pa.array([block], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.array([press(np.diff(distinct, prepend=0), total)]),
                pa.array([press(per_doc, steps, links)]),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["part", "block", "docs", "pairs", "links"])

        for piece in chunked(batches, "t"):
            held.append((piece.column("id"), Piece(piece.column("t").to_pylist(), lexicon)))
            weight += piece.column("t").nbytes
            if weight >= block_bytes:
                yield out()
                block, held, weight = block + 1, [], 0
        if held:
            yield out()

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    figures = ",".join(f"{n}:bigint" for n in _FIGURES)
    schema = f"part int, block int, docs array<struct<id:{kind},{figures},sha:string>>, pairs binary, links binary"
    return staged(rows.mapInArrow(of, schema), "alignments")


def _pairs(blocks: DataFrame) -> DataFrame:
    """(``part``, ``block``, ``pair``, ``n``): the blocks' distinct pairs, one row each."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, body in zip(*(batch.column(n).to_pylist() for n in ("part", "block", "pairs")), strict=True):
                steps, n = unpress(body, [np.int64, np.int64])
                same = [pa.array(np.full(len(n), x, np.int32)) for x in (part, block)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.cumsum(steps)), pa.array(n)], names=["part", "block", "pair", "n"])

    return blocks.select("part", "block", "pairs").mapInArrow(of, "part int, block int, pair bigint, n bigint")


def _totals(blocks: DataFrame, shift: int) -> DataFrame:
    """(``pair``, ``total``, ``best``): links of every pair, and whether its B id has no pair with more."""
    counts = _pairs(blocks).groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << shift) - 1)))  # at most one row per id of A
    return counts.withColumn("best", F.col("total") == F.max("total").over(of_b))


def _shift(path_a: str, path_b: str) -> int:
    return Lexicon(sides(path_a, path_b)).shift


def pair_counts(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``a``, ``b``, ``n``, ``best``): for every linked pair of ids its links in all texts, and whether ``b`` has none with more."""
    shift = _shift(path_a, path_b)
    totals = _totals(_blocks(docs, path_a, path_b, id_column, text_column, BLOCK_BYTES), shift)
    b = F.col("pair").bitwiseAND(F.lit((1 << shift) - 1)).cast("int")
    return totals.select(F.shiftright("pair", shift).cast("int").alias("a"), b.alias("b"), F.col("total").alias("n"), "best")


def link_statistics(
    docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """What :func:`align` counts, with ``n_best``, ``count_sum`` and ``groups_sha256``, for every row of ``docs``.

    ``n_best`` counts the links whose pair has the most links of all pairs with its B id, ties included; ``count_sum`` adds
    up the pairs' numbers over the document's links, both judged on all of ``docs``. ``groups_sha256`` is the digest of
    ``groups``, or empty without tokens. Rows as in :func:`align`.
    """
    shift = _shift(path_a, path_b)
    blocks = _blocks(docs, path_a, path_b, id_column, text_column, block_bytes)
    back = _pairs(blocks).drop("n").join(_totals(blocks, shift), "pair")
    kind = docs.schema[id_column].dataType.simpleString()

    def of(key, found: pa.Table, totals: pa.Table) -> pa.Table:
        order = np.argsort(totals.column("pair").to_numpy())
        total = totals.column("total").to_numpy()[order]
        best = totals.column("best").to_numpy()[order].astype(np.int64)
        rows = found.column("docs").combine_chunks().flatten()
        per_doc, steps, links = unpress(found.column("links")[0].as_py(), [np.int32, np.int32, np.int32])
        at = np.concatenate(([0], np.cumsum(per_doc, dtype=np.int64)))
        place = np.cumsum(steps, dtype=np.int64)
        sums = [np.concatenate(([0], np.cumsum(links * x[place]))) for x in (best, total)]
        added = [pa.array(s[at[1:]] - s[at[:-1]], pa.int64()) for s in sums]
        names = ["id", *_FIGURES]
        columns = [rows.field(n) for n in names]
        return pa.table([*columns, *added, rows.field("sha")], names=[*names, "n_best", "count_sum", "groups_sha256"])

    schema = f"id {kind}, {', '.join(f'{n} bigint' for n in _FIGURES)}, n_best bigint, count_sum bigint, groups_sha256 string"
    grouped = blocks.select("part", "block", "docs", "links").groupBy("part", "block")
    result = grouped.cogroup(back.groupBy("part", "block")).applyInArrow(of, schema)
    return result.withColumnRenamed("id", id_column)

"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items go into one automaton. A document is streamed through it word by word; the automaton's state
and matched length say at each word how long a passage of some item ends there. Passages of at least ``window`` words are
hit, and so is a whole item that is shorter. Documents are only mapped, never shuffled. Stretches without a run of benchmark
words long enough for any window are skipped by hash before the automaton sees them, which cannot change a result.

The items are dealt into shards of about ``SHARD_BYTES`` of text, counted beforehand; a shard is what a task holds and
what is sent to it. More shards mean more passes over the documents, each written before the next. Whatever is decided
about a document is decided on the spans of all shards together, so that the number of shards changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.llm.arrays import BYTE_VALUES, PrefixHash, chunked, flat, word_spans
from vinculo.session import staged

SHARD_BYTES = 1 << 20
SPANS = "array<struct<low:int,high:int>>"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
# Separators once A-Z are lower case: all of ASCII but digits and a-z.
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[0x30:0x3A] = SEPARATORS[0x61:0x7B] = SEPARATORS[0x80:] = False


def _words(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, row offsets, starts and ends of words, and the word offsets of the rows."""
    data, at = flat(texts)
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, at, SEPARATORS)
    return data, at, starts, ends, bounds


class Automaton:
    """The generalised suffix automaton of the items' words."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        texts = []
        hashes = [np.zeros(0, np.uint64)]
        for name, text in items:
            data, _, starts, ends, _ = _words(pa.array([text], pa.string()))
            hashes.append(PrefixHash(BYTE_VALUES[data]).of(starts, ends))
            raw = data.tobytes()
            words = [self.ids.setdefault(raw[a:b], len(self.ids)) for a, b in zip(starts, ends, strict=True)]
            if words:
                texts.append((name, words))
        self.hashes = np.unique(np.concatenate(hashes))
        self.least = min((min(window, len(words)) for _, words in texts), default=0)
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in texts:
            last = 0
            for word in words:
                last = self._add(last, word)
        self._name(texts)

    def _state(self, steps: dict[int, int], link: int, length: int) -> int:
        self.steps.append(steps)
        self.link.append(link)
        self.length.append(length)
        return len(self.steps) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of the longest string that ends the words to ``state`` followed by ``word``, made if need be."""
        target = self.steps[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        twin = self._state(dict(self.steps[target]), self.link[target], self.length[state] + 1)
        self.link[target] = twin
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = twin
            state = self.link[state]
        return twin

    def _add(self, last: int, word: int) -> int:
        if word in self.steps[last]:
            return self._split(last, word)
        new = self._state({}, 0, self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.steps[state]:
            self.steps[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def _name(self, texts: list[tuple[str | None, list[int]]]) -> None:
        """Note the items that hold each window, and the short items that end each state."""
        count, window = len(self.steps), self.window
        self.level = [-1] * count  # the state of the last ``window`` words
        self.short = [-1] * count  # the nearest state, from here along the links, that a whole short item is in
        names: dict[int, set] = {}
        self.shorts: dict[int, tuple[int, set]] = {}
        for name, words in texts:
            if len(words) < window:
                state = 0
                for word in words:
                    state = self.steps[state][word]
                self.shorts.setdefault(state, (len(words), set()))[1].add(name)
        for state in sorted(range(1, count), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= window:
                self.level[state] = self.level[up] if self.length[up] >= window else state
            self.short[state] = state if state in self.shorts else self.short[up] if up > 0 else -1
        for name, words in texts:
            for _, state, length in self.matches(words):
                if length >= window:
                    names.setdefault(self.level[state], set()).add(name)
        self.names = names

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """Position, state and length of the longest passage of an item that ends at each word."""
        steps, link, lengths = self.steps, self.link, self.length
        state = length = 0
        for place, word in enumerate(words):
            while state and word not in steps[state]:
                state = link[state]
                length = lengths[state]
            if word in steps[state]:
                state = steps[state][word]
                length += 1
            yield place, state, length

    def search(self, words: list[int], hit: np.ndarray) -> set:
        """Mark the words that are hit; the items whose windows occur."""
        found: set = set()
        window = self.window
        low = high = 0  # the stretch not yet marked
        for place, state, length in self.matches(words):
            if length >= window:
                found |= self.names[self.level[state]]
                if place - length + 1 > high:
                    hit[low:high] = True
                    low = place - length + 1
                high = place + 1
            short = self.short[state]
            while short > 0:
                size, names = self.shorts[short]
                if size <= length:
                    found |= names
                    hit[place - size + 1 : place + 1] = True
                up = self.link[short]
                short = self.short[up] if up > 0 else -1
        hit[low:high] = True
        return found

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[set], np.ndarray, np.ndarray, np.ndarray]:
        """For a column of texts: which words are hit, the items found per row, word starts, ends and row offsets."""
        data, _, starts, ends, bounds = _words(texts)
        hit = np.zeros(len(starts), dtype=bool)
        items: list[set] = [set() for _ in range(len(texts))]
        if not len(self.hashes) or not len(starts):
            return hit, items, starts, ends, bounds
        hashes = PrefixHash(BYTE_VALUES[data]).of(starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        # Runs of words that some item has, within rows and long enough for the shortest window.
        edge = np.flatnonzero(known)
        if len(edge):
            firsts = np.zeros(len(starts) + 1, dtype=bool)
            firsts[bounds] = True
            new = np.ones(len(edge), dtype=bool)
            new[1:] = (np.diff(edge) > 1) | firsts[edge[1:]]
            begin = np.flatnonzero(new)
            sizes = np.diff(np.append(begin, len(edge)))
            keep = sizes >= self.least
            begin, sizes = edge[begin[keep]], sizes[keep]
            rows = np.searchsorted(bounds, begin, side="right") - 1
            raw, get = data.tobytes(), self.ids.get
            for low, size, row in zip(begin.tolist(), sizes.tolist(), rows.tolist(), strict=True):
                high = low + size
                words = [get(raw[a:b], -1) for a, b in zip(starts[low:high].tolist(), ends[low:high].tolist(), strict=True)]
                items[row] |= self.search(words, hit[low:high])
        return hit, items, starts, ends, bounds


class Shards:
    """The items, shard by shard: each is collected only when its turn comes."""

    def __init__(self, items: DataFrame, id_column: str, text_column: str, window: int):
        rows = items.select(F.col(id_column).cast("string").alias("i"), F.col(text_column).alias("t"))
        self.rows, self.window = rows.where("t is not null"), window
        total = self.rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
        self.count = max(1, -(-total // SHARD_BYTES))

    def sent(self) -> Iterator[tuple[str, object]]:
        """Of each shard a key and the broadcast items; a shard is let go when the next is asked for."""
        number_of = F.pmod(F.xxhash64("i", "t"), F.lit(self.count))
        for number in range(self.count):
            shard = [tuple(row) for row in self.rows.where(number_of == number).distinct().collect()]
            sent = self.rows.sparkSession.sparkContext.broadcast(shard)
            yield hashlib.sha256(repr((self.window, sorted(shard, key=repr))).encode()).hexdigest(), sent
            sent.unpersist()


_AUTOMATA: dict[str, Automaton] = {}  # the last shard's, for the tasks that a Python worker runs in turn


def _automaton(key: str, items: list, window: int) -> Automaton:
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Automaton(items, window)
    return _AUTOMATA[key]


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    turns = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).tolist()
    return list(zip(turns[::2], turns[1::2], strict=True))


def _searched(rows: DataFrame, shards: Shards, keep_text: bool) -> DataFrame:
    """``rows`` with the columns ``n_words``, ``spans`` and ``items`` of the text in column ``t``, found by all shards.

    All but the last shard's pass are written. Without ``keep_text`` the last leaves ``t`` null.
    """
    none = {"n_words": F.lit(0), "spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")}
    rows = rows.select("*", *(value.alias(name) for name, value in none.items()))
    kinds = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    window = shards.window  # not the frame, in what is sent

    def search(frame: DataFrame, key: str, shard, last: bool) -> DataFrame:
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(key, shard.value, window)
            for part in chunked(batches, "t"):
                hit, found, _, _, bounds = automaton.scan(part.column("t"))
                earlier = zip(part.column("spans").to_pylist(), part.column("items").to_pylist(), strict=True)
                spans, names = [], []
                for (old, named), low, high, new in zip(earlier, bounds[:-1], bounds[1:], found, strict=True):
                    here = hit[low:high]
                    if old:
                        here = here.copy()
                        for x in old:
                            here[x["low"] : x["high"]] = True
                    spans.append([{"low": a, "high": b} for a, b in _runs(here)])
                    names.append(sorted({*named, *new} - {None}))
                columns = dict(zip(part.schema.names, part.columns, strict=True))
                columns |= {"n_words": pa.array(np.diff(bounds), pa.int32()), "spans": pa.array(spans, kinds)}
                columns["items"] = pa.array(names, pa.list_(pa.string()))
                if last and not keep_text:
                    columns["t"] = pa.nulls(part.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return frame.mapInArrow(of, frame.schema)

    for turn, (key, shard) in enumerate(shards.sent()):
        last = turn == shards.count - 1
        rows = search(rows, key, shard, last)
        if last:
            return rows  # not yet computed, so its shard stays
        rows = staged(rows, "contamination")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``spans`` (word ranges hit, end exclusive, sorted) and ``items`` (names, sorted).

    A null or empty text has no words. Items without words are never found; an item with a null id can hit words but is
    not named; rows of one item count as one. Repeated rows of ``docs`` and null ids stay as they are.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    rows = _searched(rows, Shards(items, item_column, "text", window), keep_text=False)
    return rows.select(F.col("id").alias(id_column), "n_words", "spans", "items")


def _cut(texts: pa.Array, hit: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, most: float) -> dict[int, str | None]:
    """The rows that are hit: their texts without the spans, or None if more than the share ``most`` of the words is hit."""
    data, at = flat(texts)
    touched = np.flatnonzero(np.add.reduceat(np.append(hit, False), bounds[:-1]) * (np.diff(bounds) > 0)).tolist()
    result: dict[int, str | None] = {}
    for row in touched:
        low, high = bounds[row], bounds[row + 1]
        here, text = hit[low:high], data[at[row] : at[row + 1]].tobytes()
        if float(here.mean()) > most:
            result[row] = None
            continue
        kept, place = [], 0
        for a, b in _runs(here):
            kept.append(text[place : starts[low + a] - at[row]])
            place = ends[low + b - 1] - at[row]
        result[row] = b"\n".join([*kept, text[place:]]).decode()
    return result


def _replaced(part: pa.RecordBatch, column: str, cut: dict[int, str | None]) -> pa.RecordBatch:
    """``part`` with the new texts, without the rows whose text is None."""
    place = part.schema.get_field_index(column)
    texts = [cut[i] if i in cut else x.as_py() for i, x in enumerate(part.column(place))]
    stays = [cut.get(i, "") is not None for i in range(part.num_rows)]
    return part.set_column(place, part.schema.field(place), pa.array(texts, pa.string())).filter(pa.array(stays, pa.bool_()))


def remove_passages(
    docs: DataFrame, items: DataFrame, window: int = 10, most: float = 0.5, text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """``docs`` without benchmark passages.

    Every hit span is cut from the text, from its first word to its last, and a line break put in its place; this is
    repeated until none is left, since words may meet over a cut. A document of whose words more than the share ``most``
    were hit, at first or in a repetition, is dropped. Texts without a hit, null and empty texts stay as they are, and so
    do all other columns. With several shards each repetition takes the spans of all of them, over the documents last cut.
    """
    shards = Shards(items, item_column, "text", window)
    if shards.count == 1:  # all repetitions in one pass
        key, shard = next(shards.sent())

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(key, shard.value, window)
            for part in chunked(batches, text_column):
                cut: dict[int, str | None] = {}
                rows, texts = np.arange(part.num_rows), part.column(text_column)
                while len(rows):
                    hit, _, starts, ends, bounds = automaton.scan(texts)
                    new = _cut(texts, hit, starts, ends, bounds, most)
                    cut |= {int(rows[row]): text for row, text in new.items()}
                    again = [row for row, text in new.items() if text is not None]
                    rows, texts = rows[again], pa.array([new[row] for row in again], pa.string())
                yield _replaced(part, text_column, cut)

        return staged(docs.mapInArrow(clean, docs.schema), "decontaminated")

    def cut_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "t"):
            _, _, starts, ends, bounds = _words(part.column("t"))
            hit = np.zeros(len(starts), dtype=bool)
            for first, spans in zip(bounds[:-1], part.column("spans").to_pylist(), strict=True):
                for x in spans:
                    hit[first + x["low"] : first + x["high"]] = True
            cut = _cut(part.column("t"), hit, starts, ends, bounds, most)
            yield _replaced(part, "t", cut).select(own)

    own = ["t" if name == text_column else f"column {place}" for place, name in enumerate(docs.columns)]
    rows = docs.toDF(*own)
    kinds, clear = rows.schema, []
    while not clear or not rows.isEmpty():
        searched = staged(_searched(rows, shards, keep_text=True), "contamination")
        clear.append(searched.where(F.size("spans") == 0).select(*own))
        rows = staged(searched.where(F.size("spans") > 0).mapInArrow(cut_once, kinds), "cut")
    return reduce(DataFrame.unionAll, clear).toDF(*docs.columns)

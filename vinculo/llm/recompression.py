"""Substring dedup by recompression: repeated windows of words, found by the names of their inner symbols.

Recompression rewrites all texts in rounds. A round names every maximal run of one symbol, then every pair of neighbours
whose first symbol belongs to the left half of the alphabet and whose second to the right half. A name is a 64-bit hash of
what it stands for, and the halves are a bit of the name, so all tasks give equal runs and pairs the same name, without
asking each other. Inside equal passages all symbols are equal but the outermost of each round, which may merge with
what stands around the passage.

For a window of ``window`` words these outermost symbols are peeled off in each round, by a rule that looks at the window
alone, until nothing would be left: the first symbol inside then is the window's core. Equal windows have equal cores.

1. Every block of documents sends the names of its distinct cores; those that occur in two documents are shared.
2. Only windows with a shared core can repeat. They are named in full, by the peeled symbols of all rounds and the rest
   inside, and beside that by a second, independent hash of their words: 128 bits that verify the repeat. Each block sends its distinct windows
   with its least document, and learns the least of all.
3. Each document removes the words covered by windows that a smaller document has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vinculo.llm.arrays import BASE, PrefixHash, flat, mixed, ranges, rows_of, string_hashes, word_spans
from vinculo.llm.exchange import (
    BLOCK_BYTES,
    NAME,
    PACKED,
    codes,
    group_starts,
    in_blocks,
    in_table,
    pack,
    pieces,
    places,
    send_codes,
    share_codes,
    shared_codes,
    to_blocks,
    unpack,
)

CHUNK = 2 << 20  # text of a block rewritten at once
# The rounds: pairs or runs. A run takes a symbol off either end of every passage, a pair half a symbol on average, so
# pairs come first; the run round shortens what pairs of equal symbols cannot. No window of 13 words outlasts them, longer
# ones end with more symbols inside.
ROUNDS = ("pairs",) * 5 + ("runs",) + ("pairs",) * 3

SEEDS = (0, 1 << 20)  # of a word's two hashes: the one the rounds start from, and the one beside them

U64 = np.uint64
_FLAG = U64(1)
HOT = 1 << 62  # cores are not counted


def _name(one: np.ndarray, two: np.ndarray, kind: int) -> np.ndarray:
    """The name of a run (symbol, length) or of a pair (symbol, symbol)."""
    return mixed(mixed(one + U64(kind)) * BASE + two)


@dataclass(frozen=True)
class Round:
    """The symbols before a round, their numbers of words, and what the round makes of them."""

    kind: str  # pairs, runs, or end
    names: np.ndarray
    words: np.ndarray
    new_of: np.ndarray  # index after the round
    left: np.ndarray  # pairs: whether a symbol is in the left half
    run_start: np.ndarray  # runs: the first symbol of each, and the end


_NONE = np.zeros(0, np.int32)


def rewrite(names: np.ndarray, row: np.ndarray) -> list[Round]:
    """All rounds over the words of a stretch of documents; ``row`` is the document of each word."""
    done = []
    words = np.ones(len(names), np.int32)
    for number, kind in enumerate(ROUNDS):
        if kind == "runs":
            starts = group_starts(names, row)
            sizes = np.diff(np.append(starts, len(names)))
            new_of = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
            done.append(Round(kind, names, words, new_of, _NONE, np.append(starts, len(names)).astype(np.int32)))
            heads = names[starts]
            names, row = np.where(sizes > 1, _name(heads, sizes.astype(U64), 1), heads), row[starts]
        else:
            left = (mixed(names + U64(number + 3)) >> U64(63)).astype(bool)
            first = np.flatnonzero(left[:-1] & ~left[1:] & (row[:-1] == row[1:]))
            stays = np.ones(len(names), dtype=bool)
            stays[first + 1] = False
            new_of = (np.cumsum(stays) - 1).astype(np.int32)
            done.append(Round(kind, names, words, new_of, left, _NONE))
            merged = names.copy()
            merged[first] = _name(names[first], names[first + 1], 2)
            names, row = merged[stays], row[stays]
        starts = np.flatnonzero(np.diff(new_of, prepend=-1))
        words = np.add.reduceat(words, starts) if len(starts) else words
    done.append(Round("end", names, words, _NONE, _NONE, _NONE))
    return done


def _longest(step: Round, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The name of the symbol with the most words in each range, the first of equals."""
    best, words = low.copy(), step.words[low]
    for shift in range(1, int((high - low).max()) if len(low) else 0):
        at = low + shift
        inside = np.flatnonzero(at < high)
        better = inside[step.words[at[inside]] > words[inside]]
        best[better], words[better] = at[better], step.words[at[better]]
    return step.names[best]


def peel(rounds: list[Round], starts: np.ndarray, window: int, full: bool) -> np.ndarray:
    """The core of each window, by the word it starts at; if ``full``, the name of the whole window instead."""
    result = np.zeros(len(starts), dtype=U64)
    place = np.arange(len(starts))
    low, high = starts.astype(np.int32), (starts + window).astype(np.int32)
    name = np.full(len(starts) if full else 0, window, dtype=U64)
    for step in rounds:
        if not len(place):
            break
        if step.kind == "pairs":
            # The first symbol may pair with what stands before, if it is a right one; the last likewise.
            off_low, off_high = ~step.left[low], step.left[high - 1]
            inner_low, inner_high = low + off_low, high - off_high
            ended = inner_low >= inner_high
        elif step.kind == "runs":
            # The outermost runs may be longer outside.
            off_low = np.minimum(step.run_start[step.new_of[low] + 1], high) - low
            off_high = high - np.maximum(step.run_start[step.new_of[high - 1]], low)
            inner_low, inner_high = low + off_low, high - off_high
            ended = inner_low >= inner_high
        else:
            ended = np.ones(len(place), dtype=bool)
        a, b = low[ended], high[ended]
        if full:
            result[place[ended]] = mixed(name[ended] + PrefixHash(step.names).of(a.astype(np.int64), b.astype(np.int64)))
        else:
            result[place[ended]] = _longest(step, a, b)
        if step.kind == "end":
            break
        go = ~ended
        place, low, high = place[go], low[go], high[go]
        inner_low, inner_high = inner_low[go], inner_high[go]
        if full:
            name = name[go]
            for symbol, count in ((step.names[low], off_low[go]), (step.names[high - 1], off_high[go])):
                name = _name(name, _name(np.where(count > 0, symbol, U64(0)), count.astype(U64), 5), 7)
        low, high = step.new_of[inner_low], step.new_of[inner_high - 1] + 1
    return result


@dataclass(frozen=True)
class Stretch:
    """Words of some documents, rewritten, with the words that start a window."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    others: np.ndarray  # a second hash of each word, of which the rounds know nothing
    rounds: list[Round]
    windows: np.ndarray
    ids: np.ndarray  # of the rows

    def doc_of(self, words: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.bounds, words, side="right") - 1]


def _stretches(docs: pa.Table, window: int) -> Iterator[Stretch]:
    for part in pieces(docs, CHUNK):
        data, at = flat(part.column("text"))
        starts, ends, bounds = word_spans(data, at)
        words, others = (string_hashes(data, starts, ends, seed) for seed in SEEDS)
        windows = ranges(bounds[:-1], np.maximum(np.diff(bounds) - window + 1, 0))
        yield Stretch(data.tobytes(), starts, ends, bounds, others, rewrite(words, rows_of(bounds)), windows, places(part.column("id")))


def _cores(stretch: Stretch, window: int) -> np.ndarray:
    return peel(stretch.rounds, stretch.windows, window, full=False)


def _send_cores(block: int, docs: pa.Table, window: int, buckets: int) -> pa.Table:
    found = []
    for stretch in _stretches(docs, window):
        core, doc = codes(_cores(stretch, window), buckets), stretch.doc_of(stretch.windows)
        new = group_starts(core, doc)  # neighbouring windows mostly share their core
        found.append((core[new], doc[new]))
    return send_codes(block, found, buckets)


def _named(stretch: Stretch, shared: np.ndarray, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows with a shared core: first word, both halves of the name, document."""
    starts = stretch.windows[in_table(codes(_cores(stretch, window), buckets), shared)[0]]
    one = peel(stretch.rounds, starts, window, full=True) & ~_FLAG
    two = PrefixHash(stretch.others).of(starts, starts + window)
    return starts, one, two, stretch.doc_of(starts)


def _least(one: np.ndarray, two: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct names with their least and greatest document."""
    order = np.lexsort((two, one))
    one, two, first, last = one[order], two[order], first[order], last[order]
    heads = group_starts(one, two)
    if not len(heads):
        return one, two, first, last
    return one[heads], two[heads], np.minimum.reduceat(first, heads), np.maximum.reduceat(last, heads)


def _window_entries(docs: pa.Table, answers: pa.Table, window: int, buckets: int) -> tuple[np.ndarray, ...]:
    shared = shared_codes(answers) & NAME
    found = [np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    for stretch in _stretches(docs, window):
        _, one, two, doc = _named(stretch, shared, window, buckets)
        here = _least(one, two, doc, doc)
        found = [np.concatenate(x) for x in zip(found, here, strict=True)]
    return _least(*found)


def _repeated(bucket: int, table: pa.Table) -> pa.Table:
    """To each block those of its windows that a document smaller than one of its own has, with the least of all."""
    blocks, (entry, two, first) = unpack(table, 3)
    one, first = entry & ~_FLAG, first.view(np.int64)
    order = np.lexsort((two, one))
    one, two, first, flags, blocks = one[order], two[order], first[order], (entry & _FLAG)[order] > 0, blocks[order]
    heads = group_starts(one, two)
    if not len(heads):
        return to_blocks(bucket, blocks, [one, two, first])
    least = np.repeat(np.minimum.reduceat(first, heads), np.diff(np.append(heads, len(one))))
    tell = flags | (least < first)
    return to_blocks(bucket, blocks[tell], [one[tell], two[tell], least[tell]])


def _marked(stretch: Stretch, named: tuple[np.ndarray, ...], one: np.ndarray, two: np.ndarray, least: np.ndarray, window: int) -> np.ndarray:
    """Which words of a stretch are removed; ``one`` is sorted, and equal halves stand together with ``two`` sorted."""
    starts, a, b, doc = named
    covered = np.zeros(len(stretch.others) + 1, dtype=np.int32)
    if len(one) and len(starts):
        at = np.searchsorted(one, a)
        alive = np.flatnonzero(at < len(one))
        at = at[alive]
        # Windows whose first halves agree are told apart by the second; one step is nearly always all there is.
        while len(alive):
            same = one[at] == a[alive]
            hit = same & (two[at] == b[alive])
            gone = alive[hit & (least[at] < doc[alive])]
            np.add.at(covered, starts[gone], 1)
            np.add.at(covered, starts[gone] + window, -1)
            more = same & ~hit & (at + 1 < len(one))
            alive, at = alive[more], at[more] + 1
    return np.cumsum(covered[:-1]) > 0


def _kept(docs: pa.Table, cores: pa.Table, windows: pa.Table, window: int, buckets: int) -> pa.Table:
    shared = shared_codes(cores) & NAME
    _, columns = unpack(windows, 3)
    order = np.lexsort((columns[1], columns[0]))
    one, two, least = columns[0][order], columns[1][order], columns[2][order].view(np.int64)
    totals, removed, kept = [], [], []
    for stretch in _stretches(docs, window):
        gone = _marked(stretch, _named(stretch, shared, window, buckets), one, two, least, window)
        bounds = stretch.bounds
        sums = np.concatenate(([0], np.cumsum(gone)))
        totals.append(np.diff(bounds))
        removed.append(sums[bounds[1:]] - sums[bounds[:-1]])
        stays = np.flatnonzero(~gone)
        cut = np.searchsorted(stays, bounds)
        raw = stretch.raw
        words = [raw[a:b] for a, b in zip(stretch.starts[stays].tolist(), stretch.ends[stays].tolist(), strict=True)]
        kept += [b" ".join(words[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    count = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (totals, removed)]
    texts = pa.array(kept, pa.binary()).cast(pa.string())
    return pa.table([docs.column("id"), pa.array(count[0], pa.int64()), pa.array(count[1], pa.int64()), texts], names=["id", "n_words", "n_removed", "kept"])


def remove_repeats(
    docs: DataFrame, window: int = 13, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(id, ``n_words``, ``n_removed``, ``kept``) for every row: the words left, joined by one space.

    A word goes if it is covered by ``window`` consecutive words that also start in a document with a smaller id, judged on
    the input. Null and empty texts have no words. Rows that share an id do not remove from each other; a row with a null
    id comes behind all others, so that it may lose words and takes none. Repeated rows stay repeated, other columns are
    ignored, an empty table gives an empty result. Integer ids.
    """
    rows, blocks = in_blocks(docs, id_column, text_column, block_bytes)
    buckets = -(-blocks // 2)

    def send_cores(key, table):
        return _send_cores(key[0].as_py(), table, window, buckets)

    def share(key, table):
        return share_codes(key[0].as_py(), table, HOT)

    def send_windows(key, table, answers):
        one, two, first, last = _window_entries(table, answers, window, buckets)
        return pack(key[0].as_py(), one, [one | (first < last).astype(U64), two, first], buckets)

    def compare(key, table):
        return _repeated(key[0].as_py(), table)

    def clean(key, table, answers):
        kind = answers.column("kind").to_numpy()
        return _kept(table, answers.filter(pa.array(kind == 0)), answers.filter(pa.array(kind == 1)), window, buckets)

    grouped = rows.groupBy("block")
    cores = grouped.applyInArrow(send_cores, PACKED).groupBy("bucket").applyInArrow(share, PACKED)
    windows = grouped.cogroup(cores.groupBy("block")).applyInArrow(send_windows, PACKED)
    repeats = windows.groupBy("bucket").applyInArrow(compare, PACKED)
    answers = cores.selectExpr("*", "0 AS kind").union(repeats.selectExpr("*", "1 AS kind"))
    result = grouped.cogroup(answers.groupBy("block")).applyInArrow(clean, "id bigint, n_words bigint, n_removed bigint, kept string")
    return result.withColumnRenamed("id", id_column)

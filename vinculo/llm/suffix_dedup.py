"""Substring dedup by suffix sorting: byte strings of a given length that a smaller document has too.

All suffixes of all documents need not be sorted together: only those that could share ``length`` bytes. Each window of
that length is filed under its anchor, the ``ANCHOR``-byte gram in it with the least hash (the first of equals). Equal
windows have equal anchors, and the windows of one anchor stand next to each other, so a document becomes a row of
overlapping strings, each holding some windows of one anchor.

1. Blocks send their anchors (32 bits each: a filter, nothing is decided by it). Those in two documents are shared.
2. Strings with a shared anchor are sent by name, each distinct one once per block; equal ones collapse, and the block
   with the least document of each sends its bytes to the task that sorts its anchor. Each window of an anchor with very
   many strings is a string of its own instead: equal ones collapse by name like other strings, so a window is an entry
   per block however many documents hold it, and nothing is left to sort.
3. That task sorts the suffixes at all windows. Two suffixes are compared by their common extension, which binary search
   finds on prefix polynomial hashes, in a mergesort; neighbours that agree in ``length`` bytes are verified byte by byte.
   Runs of equal windows get the least document of all their strings.
4. Each document removes the bytes of windows that a smaller document has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.llm.arrays import BYTE_VALUES, PrefixHash, flat, mixed, powers, ranges
from vinculo.llm.exchange import (
    BLOCK_BYTES,
    CROWDED,
    MANY,
    NAME,
    PACKED,
    bucket_of,
    codes,
    group_starts,
    in_blocks,
    in_table,
    pack,
    packed_rows,
    pieces,
    places,
    send_codes,
    share_codes,
    shared_codes,
    to_blocks,
    unpack,
    unpress,
    press,
)

CHUNK = 512 << 10
ANCHOR = 20
HOT = 40_000  # strings of an anchor above which its windows are strings of their own
WHOLE = np.uint64(0xFFFFFFFF)  # a run of all windows of a string

U64 = np.uint64
_HIGH, _LOW = U64(0xFFFFFFFF00000000), U64(0xFFFFFFFF)


# --- suffix sort --------------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of a byte sequence, compared over their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        values = BYTE_VALUES[data]
        self.powers = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(values * self.powers[:-1], out=self.sums[1:])

    def common(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The lengths of the common extensions of pairs of suffixes, at most ``length``."""
        low = np.zeros(len(one), dtype=np.int64)
        high = np.full(len(one), self.length, dtype=np.int64)
        shift_one, shift_two = self.powers[two], self.powers[one]
        base_one, base_two = self.sums[one], self.sums[two]
        for _ in range(int(self.length).bit_length()):
            half = (low + high + 1) >> 1
            equal = (self.sums[one + half] - base_one) * shift_one == (self.sums[two + half] - base_two) * shift_two
            low = np.where(equal, half, low)
            high = np.where(equal, high, half - 1)
        return low

    def below(self, one: np.ndarray, two: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix ``one`` sorts before ``two`` (or, where ``or_equal``, is equal)."""
        same = self.common(one, two)
        whole = same == self.length
        step = np.minimum(same, self.length - 1)
        return np.where(whole, or_equal, self.data[one + step] < self.data[two + step])

    def order(self, starts: np.ndarray) -> np.ndarray:
        """The suffixes sorted: by their first eight bytes, then by mergesort among those that agree."""
        keys = np.zeros(len(starts), dtype=U64)
        for step in range(min(8, self.length)):
            keys = (keys << U64(8)) | self.data[starts + step].astype(U64)
        order = np.argsort(keys, kind="stable")
        heads = group_starts(keys[order])
        sizes = np.diff(np.append(heads, len(starts)))
        begin, end = np.repeat(heads, sizes), np.repeat(heads + sizes, sizes)
        run = 1
        while run < (sizes.max() if len(sizes) else 0):
            place = np.flatnonzero(end - begin > run)  # members of classes that still have two runs
            at = place - begin[place]
            own = at // run
            other = own ^ 1
            low = begin[place] + other * run
            high = np.minimum(low + run, end[place])
            has = low < end[place]
            place, at, own, low, high = place[has], at[has], own[has], low[has], high[has]
            other_low, suffix = low.copy(), starts[order[place]]
            later = own % 2 == 1  # of equal suffixes the left run's come first
            while True:  # how many of the other run go before
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                before = self.below(starts[order[middle]], suffix[open_], later[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            pair = begin[place] + (at // (2 * run)) * (2 * run)
            to = pair + at % run + (low - other_low)
            merged = order.copy()
            merged[to] = order[place]
            order = merged
            run *= 2
        return order

    def classes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted order, and for each place in it the number of its class of suffixes with equal first bytes."""
        order = self.order(starts)
        if not len(order):
            return order, order
        new = np.ones(len(order), dtype=bool)
        one, two = starts[order[:-1]], starts[order[1:]]
        same = self.common(one, two) == self.length
        new[1:] = ~same
        for low in range(0, len(one), 65_536):  # collisions of the hash
            pairs = np.flatnonzero(same[low : low + 65_536]) + low
            span = np.arange(self.length)
            equal = (self.data[one[pairs, None] + span] == self.data[two[pairs, None] + span]).all(axis=1)
            if not equal.all():
                return self._by_bytes(starts)
        return order, np.cumsum(new) - 1

    def _by_bytes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same from the bytes themselves; only after a collision."""
        strings = self.data[starts[:, None] + np.arange(self.length)]
        order = np.lexsort(strings.T[::-1])
        new = np.ones(len(order), dtype=bool)
        new[1:] = (strings[order[1:]] != strings[order[:-1]]).any(axis=1)
        return order, np.cumsum(new) - 1


# --- strings of documents -----------------------------------------------------------------------------


class Strings:
    """The anchored strings of a stretch of documents: first and last window, anchor, name, document."""

    def __init__(self, docs: pa.Table, length: int):
        self.data, self.at = flat(docs.column("text"))
        self.ids = places(docs.column("id"))
        self.length = length
        gram = min(ANCHOR, length)
        size, windows = len(self.data), max(len(self.data) - length + 1, 0)
        self.hashes = hashes = PrefixHash(BYTE_VALUES[self.data])
        if not windows:
            self.low = self.high = np.zeros(0, np.int64)
            self.anchor = self.name = np.zeros(0, U64)
            self.doc = np.zeros(0, np.int64)
            return
        raw = (hashes.sums[gram:] - hashes.sums[: size - gram + 1]) * hashes.inverse[: size - gram + 1]
        least = (raw & _HIGH) | np.arange(len(raw), dtype=U64)
        span, wide = 1, length - gram + 1
        while span * 2 <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if wide > span:
            least = np.minimum(least[: span - wide], least[wide - span :])
        where = least & _LOW
        valid = np.ones(windows + 1, dtype=bool)  # windows within a document
        ends = self.at[1:]
        over = np.maximum(ends - length + 1, self.at[:-1])
        bad = ranges(over, ends - over)
        valid[bad[bad < windows]] = False
        valid[windows] = False
        new = np.ones(windows, dtype=bool)
        new[1:] = (where[1:] != where[:-1]) | ~valid[:-2]
        last = np.ones(windows, dtype=bool)
        last[:-1] = (where[1:] != where[:-1]) | ~valid[1:-1]
        self.low = np.flatnonzero(new & valid[:-1])
        self.high = np.flatnonzero(last & valid[:-1])
        place = where[self.low].astype(np.int64)
        self.anchor = mixed(raw[place]) & NAME
        self.name = hashes.of(self.low, self.high + length)
        self.doc = self.ids[np.searchsorted(self.at, self.low, side="right") - 1]

    def split(self, crowded: np.ndarray) -> np.ndarray:
        """Make each window of the ``crowded`` strings a string of its own; the former number of every string."""
        count = np.where(crowded, self.high - self.low + 1, 1)
        owner = np.repeat(np.arange(len(count)), count)
        alone = crowded[owner]
        low = self.low[owner] + np.where(alone, ranges(np.zeros(len(count), np.int64), count), 0)
        self.high = np.where(alone, low, self.high[owner])
        self.low, self.anchor, self.name, self.doc = low, self.anchor[owner], self.name[owner], self.doc[owner]
        self.name[alone] = self.hashes.of(low[alone], low[alone] + self.length)
        return owner


def _strings(docs: pa.Table, length: int) -> Iterator[Strings]:
    for part in pieces(docs, CHUNK):
        yield Strings(part, length)


def _least(keys: tuple[np.ndarray, np.ndarray], first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs of keys with their least and greatest document."""
    order = np.lexsort(keys[::-1])
    one, two, first, last = keys[0][order], keys[1][order], first[order], last[order]
    heads = group_starts(one, two)
    if not len(heads):
        return one, two, first, last
    return one[heads], two[heads], np.minimum.reduceat(first, heads), np.maximum.reduceat(last, heads)


# --- the steps ----------------------------------------------------------------------------------------


def _send_anchors(block: int, docs: pa.Table, length: int, buckets: int) -> pa.Table:
    return send_codes(block, [(codes(x.anchor, buckets), x.doc) for x in _strings(docs, length)], buckets)


def _send_names(block: int, docs: pa.Table, answers: pa.Table, length: int, buckets: int) -> pa.Table:
    """The block's distinct strings with a shared anchor: name, anchor and marks, least document."""
    shared = shared_codes(answers)
    plain = shared & NAME
    found = [np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    for strings in _strings(docs, length) if len(shared) else ():
        hit, at = in_table(codes(strings.anchor, buckets), plain)
        owner = strings.split(hit & ((shared[at] & CROWDED) > 0))
        hit, at = hit[owner], at[owner]
        anchor = strings.anchor[hit] | (shared[at[hit]] & CROWDED)
        here = _least((strings.name[hit], anchor), strings.doc[hit], strings.doc[hit])
        found = [np.concatenate(x) for x in zip(found, here, strict=True)]
    name, anchor, first, last = _least((found[0], found[1]), found[2], found[3])
    return pack(block, name, [name, anchor | (first < last).astype(U64), first], buckets)


def _grouped(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All blocks' strings of a bucket, sorted by name: block, name, marked anchor, least document, and the group heads."""
    blocks, (name, marked, first) = unpack(table, 3)
    first = first.view(np.int64)
    order = np.lexsort((first, marked & NAME, name))
    blocks, name, marked, first = blocks[order], name[order], marked[order], first[order]
    return blocks, name, marked, first, group_starts(name, marked & NAME)


def _ask(bucket: int, table: pa.Table) -> pa.Table:
    """Of each distinct string, ask the block with its least document for the bytes, unless it is a window of its own."""
    blocks, name, marked, first, heads = _grouped(table)
    heads = heads[(marked[heads] & CROWDED) == 0]
    return to_blocks(bucket, blocks[heads], [name[heads], marked[heads] & ~MANY, first[heads]])


def _send_bytes(block: int, docs: pa.Table, asked: pa.Table, length: int, buckets: int) -> pa.Table:
    """The bytes asked for, dealt to the tasks that sort them: name, anchor, document, number of bytes."""
    _, (name, marked, first) = unpack(asked, 3)
    if not len(name):
        return packed_rows(())
    order = np.argsort(name, kind="stable")
    marked, name, first = marked[order], name[order], first[order].view(np.int64)
    wanted = np.isin(places(docs.column("id")), np.unique(first))
    done = np.zeros(len(name), dtype=bool)
    parts: dict[int, list] = {}
    for strings in _strings(docs.filter(pa.array(wanted)), length):
        at = np.searchsorted(name, strings.name)
        rest = np.flatnonzero(at < len(name))
        at = at[rest]
        chosen, request = [], []
        while len(rest):  # one step unless names agree
            same = name[at] == strings.name[rest]
            hit = same & ((marked[at] & NAME) == strings.anchor[rest]) & (first[at] == strings.doc[rest])
            chosen.append(rest[hit])
            request.append(at[hit])
            more = same & ~hit & (at + 1 < len(name))
            rest, at = rest[more], at[more] + 1
        if not chosen:
            continue
        chosen, request = np.concatenate(chosen), np.concatenate(request)
        request, once = np.unique(request, return_index=True)
        chosen = chosen[once]
        chosen, request = chosen[~done[request]], request[~done[request]]
        done[request] = True
        low, high = strings.low[chosen], strings.high[chosen]
        size = high - low + length
        bucket = bucket_of(marked[request] & NAME, buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            pick = order[bounds[b] : bounds[b + 1]]
            own = request[pick]
            text = strings.data[ranges(low[pick], size[pick])]
            parts.setdefault(b, []).append([name[own], marked[own] & NAME, first[own], size[pick], text])
    return packed_rows((b, block, press(*(np.concatenate(x) for x in zip(*rows, strict=True)))) for b, rows in parts.items())


def _sort(bucket: int, table: pa.Table, length: int, buckets: int) -> pa.Table:
    """Sort the suffixes at all windows; runs of windows that a smaller document has than the string's own least."""
    parts = [unpress(x, [U64, U64, np.int64, np.int64, np.uint8]) for x in table.column("payload").to_pylist()]
    name, anchor, first, size, data = (np.concatenate(x) for x in zip(*parts, strict=True))
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    count = size - length + 1
    starts = ranges(begin, count)
    owner = np.repeat(np.arange(len(name)), count)
    order, number = Suffixes(data, length).classes(starts)
    heads = group_starts(number)
    least = np.empty(len(starts), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(first[owner[order]], heads), np.diff(np.append(heads, len(order))))
    better = np.flatnonzero(least < first[owner])
    offset = starts - begin[owner]
    new = np.ones(len(better), dtype=bool)
    new[1:] = (np.diff(better) > 1) | (owner[better[1:]] != owner[better[:-1]]) | (least[better[1:]] != least[better[:-1]])
    runs = np.flatnonzero(new)
    sizes = np.diff(np.append(runs, len(better)))
    at = better[runs]
    span = (offset[at].astype(U64) << U64(32)) | sizes.astype(U64)
    return pack(bucket, name[owner[at]], [name[owner[at]], anchor[owner[at]], span, least[at]], buckets)


def _answer(bucket: int, names: pa.Table, runs: pa.Table) -> pa.Table:
    """To each block, per string, the runs of windows that a document smaller than one of its own has."""
    blocks, name, marked, first, heads = _grouped(names)
    sizes = np.diff(np.append(heads, len(name)))
    least = np.repeat(first[heads], sizes) if len(heads) else first  # sorted by document within the group
    tell = ((marked & MANY) > 0) | (least < first)
    spans = np.full(int(tell.sum()), WHOLE, dtype=U64)
    out = [blocks[tell], name[tell], marked[tell] & ~MANY, spans, least[tell]]
    _, (name2, anchor2, span2, least2) = unpack(runs, 4)
    if len(name2):
        low, high = np.searchsorted(name, name2), np.searchsorted(name, name2, side="right")
        at = ranges(low, high - low)
        run = np.repeat(np.arange(len(name2)), high - low)
        same = (marked[at] & NAME) == anchor2[run]
        at, run = at[same], run[same]
        more = [blocks[at], name2[run], anchor2[run], span2[run], least2[run].view(np.int64)]
        out = [np.concatenate(x) for x in zip(out, more, strict=True)]
    return to_blocks(bucket, out[0], out[1:])


def _remove(docs: pa.Table, answers: pa.Table, length: int) -> pa.Table:
    _, (name, anchor, span, least) = unpack(answers, 4)
    order = np.argsort(name, kind="stable")
    anchor, name, span, least = anchor[order], name[order], span[order], least[order].view(np.int64)
    crowded, anchor = np.unique(anchor[(anchor & CROWDED) > 0] & NAME), anchor & NAME
    columns: list[list] = [[], [], [], []]
    for strings in _strings(docs, length):
        strings.split(in_table(strings.anchor, crowded)[0])
        covered = np.zeros(len(strings.data) + 1, dtype=np.int32)
        low, high = np.searchsorted(name, strings.name), np.searchsorted(name, strings.name, side="right")
        at, own = ranges(low, high - low), np.repeat(np.arange(len(low)), high - low)
        hit = (anchor[at] == strings.anchor[own]) & (least[at] < strings.doc[own])
        at, own = at[hit], own[hit]
        whole = span[at] == WHOLE
        start = strings.low[own] + np.where(whole, 0, (span[at] >> U64(32)).astype(np.int64))
        end = np.where(whole, strings.high[own], start + (span[at] & _LOW).astype(np.int64) - 1) + length
        np.add.at(covered, start, 1)
        np.add.at(covered, end, -1)
        gone = np.cumsum(covered[:-1]) > 0
        bounds = strings.at
        sums = np.concatenate(([0], np.cumsum(gone)))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edge = bounds[:-1][bounds[:-1] < len(gone)]
        begins[edge] = gone[edge]
        spans = np.concatenate(([0], np.cumsum(begins)))
        kept = strings.data[~gone].tobytes()
        cut = bounds - sums[bounds]
        columns[0].append(np.diff(bounds))
        columns[1].append(np.diff(sums[bounds]))
        columns[2].append(np.diff(spans[bounds]))
        columns[3] += [kept[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    numbers = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in columns[:3]]
    return pa.table([docs.column("id"), *numbers, pa.array(columns[3], pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(
    docs: DataFrame,
    length: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """(id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``) for every row; ``kept`` holds the bytes left, as binary.

    A byte of the UTF-8 text goes if it is covered by ``length`` bytes that also start in a document with a smaller id,
    judged on the input; ``n_spans`` counts the maximal runs removed. Matches do not cross documents. Null and empty texts
    have no bytes. Rows that share an id do not remove from each other; a row with a null id comes behind all others, so
    that it may lose bytes and takes none. Repeated rows stay repeated, other columns are ignored, an empty table gives
    an empty result. Integer ids. ``block_bytes`` and ``hot`` are for the size of tasks; they change no result.
    """
    rows, blocks = in_blocks(docs, id_column, text_column, block_bytes)
    buckets = -(-blocks // 2)

    def send_anchors(key, table):
        return _send_anchors(key[0].as_py(), table, length, buckets)

    def share_anchors(key, table):
        return share_codes(key[0].as_py(), table, hot)

    def send_names(key, table, answers):
        return _send_names(key[0].as_py(), table, answers, length, buckets)

    def ask(key, table):
        return _ask(key[0].as_py(), table)

    def send_bytes(key, table, asked):
        return _send_bytes(key[0].as_py(), table, asked, length, 4 * buckets)

    def sort(key, table):
        return _sort(key[0].as_py(), table, length, buckets)

    def answer(key, names, runs):
        return _answer(key[0].as_py(), names, runs)

    def remove(key, table, answers):
        return _remove(table, answers, length)

    texts = rows.groupBy("block")
    shared = texts.applyInArrow(send_anchors, PACKED).groupBy("bucket").applyInArrow(share_anchors, PACKED)
    names = texts.cogroup(shared.groupBy("block")).applyInArrow(send_names, PACKED).groupBy("bucket")
    asked = names.applyInArrow(ask, PACKED)
    sent = texts.cogroup(asked.groupBy("block")).applyInArrow(send_bytes, PACKED)
    runs = sent.groupBy("bucket").applyInArrow(sort, PACKED)
    answers = names.cogroup(runs.groupBy("bucket")).applyInArrow(answer, PACKED)
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    result = texts.cogroup(answers.groupBy("block")).applyInArrow(remove, schema)
    return result.select(F.col("id").alias(id_column), "n_bytes", "n_removed", "n_spans", "kept")

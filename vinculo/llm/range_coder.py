"""Context-mixing range coder for token ids, over many independent blocks at once.

A block codes its ids as places in an alphabet. For each id, the last id seen after the two before it (order 2) and the last
seen after the one before it (order 1) are predicted, each with a probability learned from how often predictions of that
confidence came true; their probabilities add up where they agree. What remains is shared out by order 0: the frequencies of
the alphabet, which the caller measures and passes, or equal shares. Predictions and probabilities start anew in each
block. Blocks do not depend on each other, so numpy steps through a whole batch of them side by side, an id of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 2048  # ids in a block
_SLOTS1, _SLOTS2 = 1024, 2048  # slots of the tables of orders 1 and 2, powers of two
_FAITH = 3  # bits of confidence beside a predicted place
_SURE = (1 << _FAITH) - 1
# Of a prediction's weight out of 2**16. Both at their most leave order 0 a 256th, which an interval has room for.
_LEAST, _MOST = 256, 61_440
_RATE = 4  # how fast the predictions' probabilities follow
_BITS = 20  # of the sum of the shares of order 0

U64 = np.uint64
_FULL = U64(0xFFFFFFFFFFFFFFFF)
_LOW = U64(0xFFFFFFFF)
_WORD = U64(32)


def shares(counts: np.ndarray) -> np.ndarray | None:
    """Shares of order 0 for letters that occur ``counts`` times, none below 1; none for alphabets that are too large."""
    room = (1 << _BITS) - len(counts)
    if not len(counts) or room < len(counts):
        return None
    result = 1 + counts.astype(np.int64) * room // int(counts.sum())
    result[np.argmax(result)] += (1 << _BITS) - int(result.sum())
    return result


class _Model:
    """The predictions of a batch of blocks."""

    def __init__(self, lanes: int):
        each = np.arange(lanes)
        self.bases = each * _SLOTS1, each * _SLOTS2, each << _FAITH
        self.one = self.two = np.zeros(lanes, np.int64)  # the last two places
        self.seen1, self.seen2 = np.zeros(lanes * _SLOTS1, np.uint32), np.zeros(lanes * _SLOTS2, np.uint32)  # place and confidence
        start = np.linspace(0, _MOST - _LEAST, _SURE + 1).astype(np.int64)
        self.chance1, self.chance2 = np.tile(start, lanes), np.tile(start, lanes)

    def predict(self, active: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Predicted places of orders 2 and 1 (0: none), and where their intervals end out of 2**16."""
        base1, base2, cells = (x[:active] for x in self.bases)
        self.one, self.two = self.one[:active], self.two[:active]
        self.at1 = (self.one * 40_503 >> 4 & (_SLOTS1 - 1)) + base1
        self.at2 = (self.two * 40_503 + self.one * 2_654_435 >> 5 & (_SLOTS2 - 1)) + base2
        self.held1, self.held2 = self.seen1[self.at1], self.seen2[self.at2]
        self.cell1, self.cell2 = (self.held1 & _SURE) + cells, (self.held2 & _SURE) + cells
        self.old1, self.old2 = self.chance1[self.cell1], self.chance2[self.cell2]
        guess1, guess2 = self.held1 >> _FAITH, self.held2 >> _FAITH
        weight2 = self.old2 + _LEAST
        both = weight2 + ((65_536 - weight2) * (self.old1 + _LEAST) >> 16)
        return guess2, guess1, np.where(guess1 == guess2, both, weight2), both

    def learn(self, place: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit1``: whether order 1 was right, whatever order 2 said."""
        self.chance2[self.cell2] = self.old2 + (hit2 * (_MOST - _LEAST) - self.old2 >> _RATE)
        self.chance1[self.cell1] = self.old1 + (hit1 * (_MOST - _LEAST) - self.old1 >> _RATE)
        fresh = (place << _FAITH | 1).astype(np.uint32)
        self.seen2[self.at2] = np.where(hit2, self.held2 + (self.held2 & _SURE < _SURE), fresh)
        self.seen1[self.at1] = np.where(hit1, self.held1 + (self.held1 & _SURE < _SURE), fresh)
        self.two, self.one = self.one, place


def _steps(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """How many of the blocks, longest first, still go on at each step."""
    for step in range(int(lengths.max()) if len(lengths) else 0):
        yield step, int(np.searchsorted(-lengths, -step, side="left"))


def _carry(words: np.ndarray, lanes: np.ndarray, used: np.ndarray) -> None:
    """Add one to the last word of some lanes, and on to the words before where it overflows."""
    at = used[lanes] - 1
    while len(lanes):
        words[lanes, at] += np.uint32(1)
        over = np.flatnonzero(words[lanes, at] == 0)
        lanes, at = lanes[over], at[over] - 1


def encode(places: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, order0: np.ndarray | None = None) -> list[np.ndarray]:
    """The words of each block: ``places`` (blocks x longest) in alphabets of ``sizes``; ``lengths`` must not increase.

    Places run from 1. ``order0`` has the shares of one alphabet for all blocks (see :func:`shares`).
    """
    blocks = len(lengths)
    by_step = np.ascontiguousarray(places.T)
    model = _Model(blocks)
    low, span = np.zeros(blocks, U64), np.full(blocks, _FULL, U64)
    words, used = np.zeros((blocks, places.shape[1] + 4), np.uint32), np.zeros(blocks, np.int64)
    if order0 is not None:
        counts0 = np.concatenate(([0], order0)).astype(U64)
        below0 = np.concatenate(([0, 0], np.cumsum(order0)[:-1])).astype(U64)
    for step, active in _steps(lengths):
        place = by_step[step, :active].astype(np.int64)
        guess2, guess1, cut, both = model.predict(active)
        hit2, hit1 = place == guess2, place == guess1
        miss = ~(hit2 | hit1)
        below = np.where(miss, both, np.where(hit2, 0, cut)).astype(U64)
        end = np.where(miss, 65_536, np.where(hit2, cut, both)).astype(U64)
        unit = span[:active] >> U64(16)
        more, left = unit * below, unit * (end - below)
        rest = np.flatnonzero(miss)
        own = place[rest]
        if order0 is None:
            unit = left[rest] // sizes[rest].astype(U64)
            more[rest] += unit * (own - 1).astype(U64)
            left[rest] = unit
        else:
            unit = left[rest] >> U64(_BITS)
            more[rest] += unit * below0[own]
            left[rest] = unit * counts0[own]
        more += low[:active]
        over = np.flatnonzero(more < low[:active])
        if len(over):
            _carry(words, over, used)
        short = np.flatnonzero(left <= _LOW)
        if len(short):
            settled = more[short]
            words[short, used[short]] = (settled >> _WORD).astype(np.uint32)
            used[short] += 1
            more[short] = settled << _WORD
            left[short] <<= _WORD
        low[:active], span[:active] = more, left
        model.learn(place, hit2, hit1)
    # The first number from the low end on whose second word is zero still lies in the interval; zeros are not written.
    last = low + _LOW
    _carry(words, np.flatnonzero(last < low), used)
    words[np.arange(blocks), used] = (last >> _WORD).astype(np.uint32)
    return [row[: n + 1] for row, n in zip(words, used.tolist(), strict=True)]


def decode(words: list[np.ndarray], lengths: np.ndarray, sizes: np.ndarray, order0: np.ndarray | None = None) -> np.ndarray:
    """The places (blocks x longest) that :func:`encode` was given."""
    blocks, longest = len(lengths), int(lengths.max()) if len(lengths) else 0
    width = max((len(w) for w in words), default=0) + 2
    table = np.zeros((blocks, width), np.uint32)
    for row, own in zip(table, words, strict=True):
        row[: len(own)] = own
    code = (table[:, 0].astype(U64) << _WORD) | table[:, 1]  # from the low end of the interval
    table, at = table.reshape(-1), np.arange(blocks) * width + 2
    span = np.full(blocks, _FULL, U64)
    model = _Model(blocks)
    by_step = np.zeros((longest, blocks), np.uint32)
    if order0 is not None:
        letter = np.repeat(np.arange(1, len(order0) + 1, dtype=np.uint32), order0)
        counts0 = np.concatenate(([0], order0)).astype(U64)
        below0 = np.concatenate(([0, 0], np.cumsum(order0)[:-1])).astype(U64)
    for step, active in _steps(lengths):
        guess2, guess1, cut, both = model.predict(active)
        unit = span[:active] >> U64(16)
        value = (code[:active] // unit).astype(np.int64)  # what rounding leaves above 2**16 was never coded
        by2, miss = value < cut, value >= both
        below = np.where(miss, both, np.where(by2, 0, cut)).astype(U64)
        end = np.where(miss, 65_536, np.where(by2, cut, both)).astype(U64)
        rel, left = code[:active] - unit * below, unit * (end - below)
        place = np.where(by2, guess2, guess1).astype(np.int64)
        rest = np.flatnonzero(miss)
        if order0 is None:
            unit = left[rest] // sizes[rest].astype(U64)
            own = np.minimum(rel[rest] // unit, (sizes[rest] - 1).astype(U64))
            rel[rest] -= unit * own
            left[rest] = unit
            place[rest] = own.astype(np.int64) + 1
        else:
            unit = left[rest] >> U64(_BITS)
            own = letter[np.minimum(rel[rest] // unit, U64((1 << _BITS) - 1)).astype(np.int64)]
            rel[rest] -= unit * below0[own]
            left[rest] = unit * counts0[own]
            place[rest] = own
        short = np.flatnonzero(left <= _LOW)
        if len(short):
            rel[short] = (rel[short] << _WORD) | table[at[short]]
            left[short] <<= _WORD
            at[short] += 1
        code[:active], span[:active] = rel, left
        model.learn(place, place == guess2, place == guess1)
        by_step[step, :active] = place
    return np.ascontiguousarray(by_step.T)

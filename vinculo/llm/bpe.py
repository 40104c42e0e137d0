"""Byte-pair encoding over a pair occurrence index, and decoding.

A task splits its texts into words as the vocabulary file says (normaliser and pattern) and encodes each distinct word
once. Those it has not met yet lie end to end as linked symbols; an index maps every pair of neighbours to all its
positions. The least rank among the pairs present is applied to its positions from left to right, each merge entering the
new neighbouring pairs into the index, until no pair has a rank. A word cannot see another, so the order of ranks within
a word is the one the merge table asks for. Each text's ids are then looked up word by word.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vinculo.llm.arrays import chunked

REMEMBERED = 250_000  # tokens a worker keeps in each of two generations; what is forgotten is encoded again

# Characters that every pattern engine classes alike, that are their own normal form, and whose lower case is one
# character; U+001C to U+001F, U+0085 (white space to some) and U+0130 (two characters in lower case) are left out.
PLAIN = "".join(map(chr, [*range(0x1C), *range(0x20, 0x85), *range(0x86, 0x130), *range(0x131, 0x250), *range(0x2010, 0x2028)]))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 itself, other bytes from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in printable}
    for byte in range(256):
        letters.setdefault(byte, chr(0x100 + sum(b not in printable for b in range(byte))))
    return [letters[byte] for byte in range(256)]


class Vocabulary:
    """A vocabulary file: ids of symbols, ranks of merges, special tokens, and how texts fall into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.special = {item["content"]: item["id"] for item in spec["added_tokens"]}
        self.tokens = {number: token for token, number in ids.items()} | {n: t for t, n in self.special.items()}
        suffix = model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = [ids.get(letter) for letter in letters]
        self.final = [ids.get(letter + suffix) for letter in letters]
        self.ranks: dict[int, int] = {}  # of a pair, written as one number
        self.rules: list[tuple[int, int, int]] = []  # of a rank: the pair and what it becomes
        for rank, merge in enumerate(model["merges"]):
            one, two = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks.setdefault(ids[one] << 32 | ids[two], rank)
            self.rules.append((ids[one], ids[two], ids[one + two]))
        (splitter, *_) = spec["pre_tokenizer"]["pretokenizers"]
        pattern = splitter["pattern"]["Regex"]
        self.words_of = regex.compile(pattern).findall
        self.library = Tokenizer.from_file(path)
        self.separate = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.unusual = re.compile(f"[^{re.escape(PLAIN)}]").search

    def tokens_of(self, text: str) -> list[str]:
        """The stretches a text is looked up by: special tokens (after a carriage return, which no other stretch has),
        and what lies between white space, normalised.

        No word of the pattern crosses white space, so the words of a stretch are the same wherever it stands. Texts
        with characters that two engines could class differently are split by the library itself.
        """
        if "<|" in text:
            parts = self.separate(text)
            return [x for turn, part in enumerate(parts) for x in (["\r" + part] if turn % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if self.unusual(text) is None:
            return text.lower().split()
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return ["\n" + bytes(map(_bytes_of_letters().__getitem__, piece)).decode() for piece, _ in pieces]

    def words(self, token: str) -> list[str]:
        """The words of a stretch; a leading line break marks one that the library has split already."""
        return [token[1:]] if token[0] == "\n" else self.words_of(token)


@lru_cache(maxsize=1)
def _bytes_of_letters() -> dict[str, int]:
    return {letter: byte for byte, letter in enumerate(_byte_letters())}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_words(words: list[str], vocab: Vocabulary) -> list[list[int]]:
    """The ids of every word, from one index over all of them."""
    symbols: list[int] = []
    bounds = [0]
    inner, final = vocab.inner.__getitem__, vocab.final
    for word in words:
        raw = word.encode()
        symbols.extend(map(inner, raw[:-1]))
        symbols.append(final[raw[-1]])
        bounds.append(len(symbols))
    size = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    for bound in bounds[1:]:  # no links between words
        after[bound - 1] = -1
        if bound < size:
            before[bound] = -1
    index: dict[int, list[int]] = {}
    rank_of, rules = vocab.ranks.get, vocab.rules
    for place, other in enumerate(after):
        if other > 0 and (rank := rank_of(symbols[place] << 32 | symbols[other])) is not None:
            if rank in index:
                index[rank].append(place)
            else:
                index[rank] = [place]
    active = sorted(index)
    while active:
        rank = heappop(active)
        one, two, merged = rules[rank]
        for place in sorted(index.pop(rank)):
            other = after[place]
            if other < 0 or symbols[place] != one or symbols[other] != two:
                continue  # an earlier merge has taken one of the two
            symbols[place], symbols[other] = merged, -1
            after[place] = following = after[other]
            after[other] = -1
            if following >= 0:
                before[following] = place
                if (fresh := rank_of(merged << 32 | symbols[following])) is not None:
                    if fresh in index:
                        index[fresh].append(place)
                    else:
                        index[fresh] = [place]
                        heappush(active, fresh)
            preceding = before[place]
            if preceding >= 0 and (fresh := rank_of(symbols[preceding] << 32 | merged)) is not None:
                if fresh in index:
                    index[fresh].append(preceding)
                else:
                    index[fresh] = [preceding]
                    heappush(active, fresh)
    return [[n for n in symbols[low:high] if n >= 0] for low, high in zip(bounds, bounds[1:])]  # noqa: B905


class Encoder:
    """Encodes texts; tokens met before are looked up."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.recent: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def _learn(self, tokens: set[str]) -> None:
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        fresh = []
        for token in tokens.difference(self.recent):
            if (ids := self.older.get(token)) is not None:
                self.recent[token] = ids
            elif (number := self.vocab.special.get(token[1:]) if token[0] == "\r" else None) is not None:
                self.recent[token] = [number]
            else:
                fresh.append(token)
        words = list(map(self.vocab.words, fresh))
        distinct = list(set(chain.from_iterable(words)))
        ids_of = dict(zip(distinct, encode_words(distinct, self.vocab), strict=True))
        for token, parts in zip(fresh, words, strict=True):
            self.recent[token] = ids_of[parts[0]] if len(parts) == 1 else [n for part in parts for n in ids_of[part]]

    def __call__(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.vocab.tokens_of(text) if text else [] for text in texts]
        self._learn(set(chain.from_iterable(split)))
        known = self.recent.__getitem__
        return [list(chain.from_iterable(map(known, tokens))) for tokens in split]


@lru_cache(maxsize=2)
def encoder_for(path: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs in turn."""
    return Encoder(vocabulary(path))


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (id, ``ids`` array of int) for every row of ``docs``, in no order.

    Whole texts; null and empty texts have no ids. Null and repeated ids are carried along, other columns ignored. The
    vocabulary's special tokens count as such where they stand in a text.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for part in chunked(batches, "t"):
            ids = encoder(part.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    return rows.mapInArrow(of, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decoded(ids: list[int], vocab: Vocabulary) -> str:
    """The text of ``ids``: this vocabulary has no decoder, so its tokens are joined by spaces."""
    return " ".join(map(vocab.tokens.__getitem__, ids))


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode every text; (id, ``ids`` string of decimal ids, ``decoded`` string) as digests and counts.

    Returns id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: the digests are taken inside the task, since ids and
    decoded texts are several times the input. Use :func:`encode` for the ids themselves.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder, sha = encoder_for(path), hashlib.sha256
        decimal = {number: str(number) for number in vocab.tokens}.__getitem__
        for part in chunked(batches, "t"):
            ids = encoder(part.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(map(len, ids), pa.int64()),
                    pa.array(sha(" ".join(map(decimal, row)).encode()).hexdigest() for row in ids),
                    pa.array(sha(decoded(row, vocab).encode()).hexdigest() for row in ids),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(of, schema).withColumnRenamed("id", id_column)

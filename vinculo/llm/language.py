"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter keeps, at each of its slots, one bit per language. The slots of an n-gram, intersected, give
all languages that hold the n-gram at once. Training counts n-grams over every labelled document with Spark and admits
to a language's filter the n-grams typical of it. A text is scored by counting, for each language, the n-grams whose mask
has its bit (population counts by column of the masks), corrected for the filter's false positives, which the fill of each
language's bit plane gives exactly. All typical n-grams are in the filter. Its slots grow with their number up to a bound;
beyond it the planes fill up, and the correction grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculo.llm.arrays import chunked, flat, mixed, rows_of
from vinculo.session import staged

GRAM = 4  # bytes of an n-gram, over letters and one space between words
SLOT_BITS, MOST_SLOT_BITS = 18, 22  # from 2**18 to 2**22 slots, each of 8 bytes for every 64 languages
SLOTS_PER_GRAM = 12  # of the language with the most n-grams
PROBES = 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# Letters for this purpose: a-z and all bytes of letters beyond ASCII; everything else separates words.
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a column as 32-bit numbers, and the row of each.

    A run of bytes other than letters counts as one space, and each text is padded by a space on both sides.
    """
    data, at = flat(texts)
    padded = np.full(len(data) + 2 * (len(at) - 1), 0x20, dtype=np.uint8)
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at) + 2)
    padded[np.arange(len(data)) + 2 * rows_of(at) + 1] = _LOWER[data]
    letters = _LETTERS[padded]
    keep = letters.copy()
    keep[1:] |= letters[:-1] | (rows[1:] != rows[:-1])  # one separator after letters, or at the start of a row
    keep[:1] = True
    values, rows = np.where(letters, padded, 0x20)[keep].astype(np.uint32), rows[keep]
    if len(values) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    last = len(values) - GRAM + 1
    grams = np.zeros(last, dtype=np.uint32)
    for shift in range(GRAM):
        grams = (grams << np.uint32(8)) | values[shift : shift + last]
    whole = rows[:last] == rows[GRAM - 1 :]
    return grams[whole], rows[:last][whole]


def _slots(grams: np.ndarray, slot_bits: int, probes: int) -> Iterator[np.ndarray]:
    hashes = mixed(grams.astype(np.uint64) + np.uint64(1))
    one, two = hashes >> np.uint64(32), (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    for probe in range(probes):
        yield ((one + np.uint64(probe) * two) & np.uint64((1 << slot_bits) - 1)).astype(np.int64)


def gram_counts(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """(``lang``, ``gram``, ``n``) over all rows of ``docs``; each task adds up its own rows before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def added(parts):
            grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return grams, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)

        def out():
            for name, parts in totals.items():
                grams, counts = added(parts)
                columns = [pa.array([name] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

        for part in chunked(batches, "t"):
            grams, rows = _grams(part.column("t"))
            codes = part.column("lang").dictionary_encode()
            of_gram = codes.indices.to_numpy()[rows]
            for code, name in enumerate(codes.dictionary.to_pylist()):
                parts = totals.setdefault(name, [])
                parts.append(np.unique(grams[of_gram == code], return_counts=True))
                if len(parts) == 16:
                    totals[name] = [added(parts)]
            held = sum(len(g) for parts in totals.values() for g, _ in parts)
            if held > 4_000_000:
                yield from out()
                totals.clear()
        yield from out()

    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("t")).where("lang is not null and t is not null")
    return rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """The names of the languages and the filter: ``planes`` words of 64 languages per slot."""

    languages: list[str]
    masks: np.ndarray  # (slots, planes) of uint64
    probes: int

    def false_positives(self) -> np.ndarray:
        """Per language the chance that a foreign n-gram has its bit: the fill of its plane to the power of the probes."""
        bits = np.unpackbits(self.masks.view(np.uint8), axis=1, bitorder="little")[:, : len(self.languages)]
        return bits.mean(axis=0) ** self.probes


def typical_grams(counts: DataFrame) -> DataFrame:
    """(``lang``, ``gram``) where the n-gram's share of the language is above its share averaged over all languages.

    ``counts`` has (``lang``, ``gram``, ``n``). With one language all its n-grams are typical.
    """
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = totals.count()
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    means = shares.groupBy("gram").agg((F.sum("share") / max(languages, 1)).alias("mean"))
    return shares.join(means, "gram").where((F.col("share") > F.col("mean")) | F.lit(languages == 1)).select("lang", "gram")


def _slot_bits(grams: int, least: int, most: int) -> int:
    return max(least, min(most, (grams * SLOTS_PER_GRAM - 1).bit_length()))


def filled_slots(typical: DataFrame, names: list[str], slot_bits: int, probes: int) -> DataFrame:
    """(``slot``, ``plane``, ``bits``): the words of the filter that are not zero, put together on the executors."""
    places = {name: place for place, name in enumerate(names)}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.array([places[name] for name in batch.column("lang").to_pylist()], dtype=np.int64)
            bits = (np.uint64(1) << (place % 64).astype(np.uint64)).view(np.int64)
            for slots in _slots(batch.column("gram").to_numpy().astype(np.uint32), slot_bits, probes):
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(place // 64), pa.array(bits)], names=["slot", "plane", "bits"])

    words = typical.select("lang", "gram").mapInArrow(of, "slot bigint, plane bigint, bits bigint")
    return words.groupBy("slot", "plane").agg(F.bit_or("bits").alias("bits"))


def train(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    slot_bits: int = SLOT_BITS,
    most_slot_bits: int = MOST_SLOT_BITS,
    probes: int = PROBES,
) -> Model:
    """Fit the filters on all rows with a language and a text.

    Every n-gram typical of a language (``typical_grams``) enters its filter. The number of slots follows the greatest
    number of them, from ``2**slot_bits`` to ``2**most_slot_bits``; the driver sees the filter alone, 8 bytes for each slot
    and 64 languages.
    """
    counts = staged(gram_counts(docs, lang_column, text_column), "grams")
    typical = staged(typical_grams(counts), "typical")
    names = [row["lang"] for row in counts.select("lang").distinct().orderBy("lang").toLocalIterator()]
    most = typical.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = _slot_bits(most, slot_bits, most_slot_bits)
    masks = np.zeros((1 << bits, max(1, -(-len(names) // 64))), dtype=np.uint64)
    words = filled_slots(typical, names, bits, probes).toArrow()
    slot, plane, word = (words.column(name).to_numpy() for name in ("slot", "plane", "bits"))
    masks[slot, plane] = word.view(np.uint64)
    return Model(names, masks, probes)


def score(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per row the corrected share of n-grams that each language holds (rows x languages), and the number of n-grams."""
    grams, rows = _grams(texts)
    counts = np.bincount(rows, minlength=len(texts)).astype(np.int64)
    slot_bits = int(model.masks.shape[0]).bit_length() - 1
    hits = np.zeros((len(texts), len(model.languages)))
    if not len(model.languages):
        return hits, counts
    masks = None
    for slots in _slots(grams, slot_bits, model.probes):
        masks = model.masks[slots] if masks is None else masks & model.masks[slots]
    full = np.flatnonzero(counts)
    starts = np.searchsorted(rows, full)
    for place in range(len(model.languages)):
        bit = (masks[:, place // 64] >> np.uint64(place % 64)) & np.uint64(1)
        if len(full):
            hits[full, place] = np.add.reduceat(bit, starts)
    chance = model.false_positives()
    seen = np.maximum(counts, 1)[:, None]
    return np.clip((hits / seen - chance) / np.maximum(1 - chance, 1e-9), 0, 1), counts


def best_language(texts: pa.Array, known: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row the place of the best language (one past the last: ``und``), its score and share, and whether it has no n-gram."""
    shares, counts = score(texts, model)
    if not model.languages:
        zero = np.zeros(len(texts))
        return np.zeros(len(texts), np.int64), zero, zero, counts == 0
    top, total = shares.max(axis=1), shares.sum(axis=1)
    value = np.where(known & (total > 0), top / np.maximum(total, 1e-300), 0.0)
    return np.where(known, shares.argmax(axis=1), len(model.languages)), value, top, counts == 0


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``lang_pred``, ``score``, ``share``) for every row of ``docs``, from the text alone.

    ``share`` is the corrected share of the text's n-grams that the best language holds, null for a text too short to
    have any; ``score`` is the best language's part of all languages' shares. Ties go to the first language by name, with
    score 0 if no language holds any n-gram. A null text and one without a letter are ``und`` with score 0, as is
    everything if no language was learned. Rows with null or repeated ids are scored like any other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is set by parameters

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*shared.value.languages, "und"])
        for part in chunked(batches, "t"):
            known = part.column("known").to_numpy(zero_copy_only=False)
            best, value, share, none = best_language(part.column("t"), known, shared.value)
            columns = [part.column("id"), names.take(pa.array(best)), pa.array(value), pa.array(share, mask=none)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "share"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"), has_letter(F.col(text_column)).alias("known"))
    schema = f"id {kind}, lang_pred string, score double, share double"
    return rows.mapInArrow(of, schema).withColumnRenamed("id", id_column)


def keep_known(docs: DataFrame, model: Model, least_share: float, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in a learned language, with all their columns.

    A row goes if its text is null or has no letter, or if less than ``least_share`` of its n-grams belong to the language
    that holds most of them; a text too short for an n-gram stays. Each row is judged by its text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, text_column):
            known = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False)
            _, _, share, none = best_language(part.column(text_column), known, shared.value)
            stays = known & (none | (share >= least_share)) & bool(shared.value.languages)
            yield part.select(range(part.num_columns - 1)).filter(pa.array(stays))

    known = has_letter(F.col(text_column))
    return docs.select("*", known.alias("has a letter")).mapInArrow(of, docs.schema)


def held_out(id_column: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: the checksum of its id, as text, falls into the fold. A null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))

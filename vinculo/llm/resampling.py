"""Importance resampling towards a target distribution, over hashed n-grams of words.

Texts are lower-cased, split and flattened by Arrow kernels, and their words are dictionary-encoded; shifted copies of
the dictionary indices form n-grams. Only distinct (n-gram, word) pairs are hashed, each from the CRC of its beginning,
and every occurrence takes its bucket from them. A document's weight adds up the gains of its buckets, by a segment
reduction.

Two passes read the texts: one counts buckets (a task sends one row per filled bucket), one weighs documents. Between them
stands a table of one gain per bucket, whose size is a parameter. What follows moves three numbers a document: ranks come
from a range partitioning by score, and from the numbers of documents in the partitions before.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinculo.llm.arrays import chunked
from vinculo.session import staged

# What parts words: ASCII but for digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

COUNTS = "bucket int, n bigint"


class Grams:
    """The runs of 1 to ``longest`` words of some texts: their buckets, text by text, and the numbers of words."""

    def __init__(self, texts: pa.Array, longest: int, buckets: int):
        size = len(texts)
        lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
        words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
        filled = pc.not_equal(words, "")  # what stands before a leading separator, or behind a trailing one
        words, row = words.filter(filled).dictionary_encode(), rows.filter(filled).to_numpy()
        index = words.indices.to_numpy().astype(np.int64)
        spelt = [w.encode() for w in words.dictionary.to_pylist()]
        self.words = np.bincount(row, minlength=size)
        gram, crc = index, np.fromiter(map(zlib.crc32, spelt), np.int64, len(spelt))
        kinds = len(spelt)
        place, owner = [crc[gram] % buckets], [row]
        for shift in range(1, longest):
            # n-grams that begin at a word and have ``shift`` more words in the same text.
            inside = row[shift:] == row[:-shift] if shift < len(row) else np.zeros(0, bool)
            pairs, gram = np.unique(gram[: len(inside)][inside] * kinds + index[shift:][inside], return_inverse=True)
            crc = np.array([zlib.crc32(b" " + spelt[w], c) for w, c in zip((pairs % kinds).tolist(), crc[pairs // kinds].tolist(), strict=True)], np.int64)
            own = np.flatnonzero(inside)
            place.append(crc[gram] % buckets)
            owner.append(row[own])
            # Back to one value per word, so that the next shift lines up; what did not fit can not begin a longer one.
            wide = np.zeros(len(inside), np.int64)
            wide[own] = gram
            gram = wide
        self.bucket = np.concatenate(place) if longest > 1 else place[0]
        self.row = np.concatenate(owner) if longest > 1 else owner[0]
        if longest > 1:
            order = np.argsort(self.row, kind="stable")
            self.bucket, self.row = self.bucket[order], self.row[order]
        self.features = np.bincount(self.row, minlength=size)

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """Each text's sum of gains; a text without features weighs nothing."""
        result = np.zeros(len(self.features), np.int64)
        some = np.flatnonzero(self.features)
        if len(some):
            starts = np.cumsum(self.features) - self.features
            result[some] = np.add.reduceat(gains.take(self.bucket), starts[some])
        return result


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = 10_000, text_column: str = "text") -> DataFrame:
    """(``bucket``, ``n``): how many n-grams of all texts fall in every bucket that has any. Null texts have none."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in chunked(batches, "t"):
            total += np.bincount(Grams(part.column("t"), longest, buckets).bucket, minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(total[filled])], names=["bucket", "n"])

    counted = docs.select(F.col(text_column).alias("t")).mapInArrow(of, COUNTS)
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """For every bucket the thousandths, rounded down, of the log ratio of its smoothed shares in target and source.

    The two tables of counts come to the driver: at most ``buckets`` rows each, whatever the size of the corpus.
    """
    s, t = (np.zeros(buckets) for _ in range(2))
    for total, frame in ((s, source), (t, target)):
        for row in frame.collect():
            total[row["bucket"]] = row["n"]
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(
    docs: DataFrame, gains: np.ndarray, longest: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, ``n_words``, ``n_features``, ``weight``) for every row of ``docs``; null and empty texts weigh nothing."""
    buckets = len(gains)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunked(batches, "t"):
            grams = Grams(part.column("t"), longest, buckets)
            columns = map(pa.array, (grams.words.astype(np.int64), grams.features.astype(np.int64), grams.weights(gains)))
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    return rows.mapInArrow(of, f"id {kind}, n_words bigint, n_features bigint, weight bigint").withColumnRenamed("id", id_column)


def gumbel(id_column: Column, seed: int) -> Column:
    """Thousandths, rounded down, of a Gumbel variate drawn from the id; a null id counts as an empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(rows: DataFrame, percent: int, *order: Column) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3, ... in ``order`` for the first ``percent`` of its ``eligible`` rows, else null.

    The share is rounded down. No task holds more than a range of the rows: ranges are cut by Spark, sorted each on its own,
    and shifted by the numbers of rows before them. Rows are written first with a number each, so that equal ones can be
    told apart.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = ~F.col("eligible")
    numbered = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "scores")
    cut = numbered.repartitionByRange(parts, last, *order, F.col("_row")).withColumn("_part", F.spark_partition_id())
    held = staged(cut, "ranges")
    sizes = held.groupBy("_part").agg(F.count_if("eligible").alias("_n"))
    before = Window.orderBy("_part")  # as many rows as ranges
    sizes = sizes.select(
        "_part",
        (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
        F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    own = F.row_number().over(Window.partitionBy("_part").orderBy(last, *order, F.col("_row")))
    ranked = held.withColumn("_own", own).join(F.broadcast(sizes), "_part").withColumn("_rank", F.col("_own") + F.col("_before"))
    taken = F.col("eligible") & (F.col("_rank") <= F.floor(F.col("_all") * percent / 100))
    return ranked.withColumn("rank", F.when(taken, F.col("_rank"))).select(*rows.columns, "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, ``n_features``, ``weight``, ``score``, ``rank``) for every row of ``docs``.

    Features are runs of 1 to ``longest`` words, repeats counted. Of the rows with at least ``least_words`` words the share
    ``percent`` (rounded down) with the highest scores is drawn without replacement: ``rank`` counts from 1 for them, ties to
    the smaller id, null ids last; it is null for the rest. Null and empty texts have no words. Repeated rows are rows of
    their own and may be drawn each; other columns are ignored; an empty table gives an empty result.
    """
    gains = bucket_gains(bucket_counts(docs, longest, buckets, text_column), bucket_counts(target, longest, buckets, text_column), buckets)
    rows = weighted(docs, gains, longest, id_column, text_column).withColumnRenamed(id_column, "id")
    rows = rows.select(
        "id", "n_features", "weight", (F.col("weight") + gumbel(F.col("id"), seed)).alias("score"), (F.col("n_words") >= least_words).alias("eligible")
    )
    result = draw(rows, percent, F.col("score").desc(), F.col("id").asc_nulls_last()).drop("eligible")
    return result.withColumnRenamed("id", id_column)

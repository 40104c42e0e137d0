"""Exact BM25 top-k search: a sharded inverted index with block maxima, pruned as in block-max WAND, merged exactly.

Tasks turn the documents they read into shards of some thousand rows. Within a shard, documents with the same leading word
stand together, and every ``BLOCK`` of them has the greatest impact of each frequent term. Queries come in blocks whose
size is bounded, and every block meets every shard.

For a batch of queries, a block's bound is the sum of its maxima, times the terms' weights, and of what its documents
really get from rarer terms, by their postings. Blocks are visited from the highest bounds on; a query skips every
block whose bound is below its k-th best score so far, in all shards its task has seen. Scores are summed in single
precision with a margin for rounding; those that could be among the best are summed again exactly, in integers of a
billionth, so that equal documents have equal scores in any order of summation. Document counts, lengths and frequencies are those of the whole table, so shards
merge exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinculo.llm.arrays import chunked, flat, ranges, rows_of, string_hashes, word_spans
from vinculo.llm.decontaminate import LOWER, SEPARATORS
from vinculo.llm.exchange import group_starts, press, unpress
from vinculo.session import staged

K1, B = 1.2, 0.75
UNIT = 1_000_000_000  # scores are whole numbers of billionths
SHARD_ROWS, SHARD_BYTES = 4096, 12 << 20
BLOCK = 64  # documents
BATCH = 256  # queries evaluated together in a task
# Of a shard's documents: terms above it have block maxima and columns, those below go by their postings. A column costs a
# product for every query and document, a posting costs more but is met only by queries with its term; here both cost alike.
FREQUENT = 0.05
EXACT_ROWS = 1024  # pairs whose exact scores are summed at once
QUERY_TERMS = 3_000_000  # terms of a block of queries: at most so many, or one query
MARGIN = 1e-4  # relative error of single precision sums, generously

_ARRAYS = [np.int64, np.uint8, np.int64, np.int64, np.int32, np.int32, np.uint64]


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit terms of a column, and the row offsets. A term is a maximal run of digits, a-z and characters beyond ASCII."""
    terms, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for part in chunked(iter([pa.record_batch([texts], names=["t"])]), "t"):  # hashing takes many times the text
        data, at = flat(part.column("t"))
        data = LOWER[data]
        starts, ends, bounds = word_spans(data, at, SEPARATORS)
        terms.append(string_hashes(data, starts, ends))
        counts.append(np.diff(bounds))
    return np.concatenate(terms), np.cumsum(np.concatenate(counts))


@dataclass(frozen=True)
class Shard:
    """Documents, term by term: ``place`` points into ``vocabulary``, rows are delimited by ``offsets``."""

    ids: np.ndarray
    null: np.ndarray
    lengths: np.ndarray
    offsets: np.ndarray
    place: np.ndarray
    counts: np.ndarray
    vocabulary: np.ndarray

    def pressed(self) -> bytes:
        arrays = (self.ids, self.null, self.lengths, self.offsets, self.place, self.counts, self.vocabulary)
        return press(*(np.asarray(x, dtype=kind) for x, kind in zip(arrays, _ARRAYS, strict=True)))


def _shard(table: pa.Table) -> Shard:
    terms, bounds = _terms(table.column("t").combine_chunks())
    row, size = rows_of(bounds), table.num_rows
    order = np.lexsort((terms, row))
    terms, row = terms[order], row[order]
    heads = group_starts(row, terms)
    counts = np.diff(np.append(heads, len(terms)))
    terms, row = terms[heads], row[heads]
    # Documents are put in the order of their most frequent term, mostly a function word of their language.
    lead = np.zeros(size, np.uint64)
    best = np.lexsort((counts, row))
    lead[row[best]] = terms[best]  # the last assignment of a row is its greatest count
    rank = np.empty(size, np.int64)
    rank[np.argsort(lead, kind="stable")] = np.arange(size)
    vocabulary, place = np.unique(terms, return_inverse=True)
    order = np.argsort(rank[row], kind="stable")
    place, counts = place[order], counts[order]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(rank[row], minlength=size))))
    ids = table.column("id").combine_chunks()
    by_rank = np.argsort(rank)
    null = np.asarray(ids.is_null())[by_rank]
    return Shard(ids.fill_null(0).to_numpy()[by_rank], null, np.diff(bounds)[by_rank], offsets, place, counts, vocabulary)


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The shards of all rows, written: (``n_docs``, ``n_terms``, ``body``). Documents are mapped, not shuffled."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0

        def out() -> pa.RecordBatch:
            shard = _shard(pa.Table.from_batches(held))
            row = [[len(shard.ids)], [int(shard.lengths.sum())], [shard.pressed()]]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["n_docs", "n_terms", "body"])

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                held.append(part)
                rows += part.num_rows
                size += int(flat(part.column("t"))[1][-1])
                if rows >= SHARD_ROWS or size >= SHARD_BYTES:
                    yield out()
                    held, rows, size = [], 0, 0
        if rows:
            yield out()

    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("t"))
    return staged(rows.mapInArrow(of, "n_docs bigint, n_terms bigint, body binary"), "index")


def _load(body: bytes) -> Shard:
    return Shard(*unpress(body, _ARRAYS))


@dataclass(frozen=True)
class Queries:
    """A block of queries: ids, row offsets, and places in the sorted ``terms``, whose weights are inverse frequencies."""

    ids: list
    offsets: np.ndarray
    place: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def _shared_out(index: DataFrame) -> DataFrame:
    """The shards, in as many partitions as there are cores.

    A task answers a block of queries with so many rows a query, however many shards it has; were the tasks to grow in
    number with the documents, as the queries do, their rows would grow with the square.
    """
    return index.select("body").coalesce(index.sparkSession.sparkContext.defaultParallelism)


def _frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many documents each of the sorted terms occurs."""
    shared = index.sparkSession.sparkContext.broadcast(terms)  # a query block's, so bounded

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for body in batch.column("body"):
                shard = _load(body.as_py())
                at = np.minimum(np.searchsorted(shared.value, shard.vocabulary), max(len(shared.value) - 1, 0))
                hit = np.flatnonzero(shared.value[at] == shard.vocabulary) if len(shared.value) else np.zeros(0, np.int64)
                counts[at[hit]] += np.bincount(shard.place, minlength=len(shard.vocabulary))[hit]
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], names=["place", "n"])

    counted = _shared_out(index).mapInArrow(of, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    result = np.zeros(len(terms), np.int64)
    result[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    shared.unpersist()
    return result


def _query_blocks(docs: DataFrame, wanted: Column, id_column: str, text_column: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and distinct sorted terms of the queries, a bounded block at a time."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, bounds = _terms(batch.column("t"))
            rows = [np.unique(terms[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [batch.column("id"), pa.array([len(x) for x in rows], pa.int64()), pa.array([x.tobytes() for x in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "terms"])

    rows = docs.where(wanted).select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("t"))
    queries = staged(rows.mapInArrow(of, "id bigint, size bigint, terms binary"), "queries")
    total = queries.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    count = max(1, -(-2 * total // QUERY_TERMS))
    block = F.pmod(F.xxhash64("id", "terms"), F.lit(count))
    for number in range(count):
        table = queries.where(block == number).select("id", "terms").toArrow()
        yield table.column("id").to_pylist(), [np.frombuffer(x, np.uint64) for x in table.column("terms").to_pylist()]


def _leading(query: np.ndarray, units: np.ndarray, null: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of each query's ``top`` best hits, in order."""
    order = np.lexsort((ids, null, -units, query))
    ranked = query[order]
    return order[np.arange(len(ranked)) - np.searchsorted(ranked, ranked) < top]


class _Evaluator:
    """A shard made ready for one block of queries."""

    def __init__(self, shard: Shard, queries: Queries, average: float, top: int):
        self.shard, self.queries, self.top = shard, queries, top
        size, words = len(shard.ids), len(shard.vocabulary)
        long = shard.lengths / average if average else shard.lengths.astype(float)
        norm = np.repeat(K1 * (1 - B + B * long), np.diff(shard.offsets))
        at = np.minimum(np.searchsorted(queries.terms, shard.vocabulary), max(len(queries.terms) - 1, 0))
        hit = queries.terms[at] == shard.vocabulary if len(queries.terms) else np.zeros(words, bool)
        self.weight = np.where(hit, queries.weights[at], 0.0) if len(queries.terms) else np.zeros(words)
        impact = self.weight[shard.place] * (shard.counts * (K1 + 1) / (shard.counts + norm))
        units = np.rint(impact * UNIT)  # whole numbers, whose sums in double precision are exact below 2**53
        row = rows_of(shard.offsets)
        # Of each query term its place in the shard, or none.
        own = np.full(len(queries.terms), -1, np.int64)
        own[at[hit]] = np.flatnonzero(hit)
        self.own = own
        spread = np.bincount(shard.place, minlength=words)
        frequent = np.flatnonzero(hit & (spread > FREQUENT * size))
        self.column = np.full(words, -1, np.int64)
        self.column[frequent] = np.arange(len(frequent))
        self.blocks = -(-size // BLOCK)
        self.whole = np.zeros((self.blocks * BLOCK, len(frequent)))
        column = self.column[shard.place]
        often = column >= 0
        self.whole[row[often], column[often]] = units[often]
        self.dense = self.whole.astype(np.float32)
        self.maxima = self.dense.reshape(self.blocks, BLOCK, -1).max(axis=1)
        # Postings of the other terms.
        rare = np.flatnonzero(hit[shard.place] & ~often)
        order = rare[np.argsort(shard.place[rare], kind="stable")]
        self.posting_row, self.posting_units = row[order], units[order]
        self.posting_at = np.searchsorted(shard.place[order], np.arange(words + 1))

    def search(self, first: int, last: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best documents of queries [first, last): query, row of the shard, score.

        ``best`` has the best scores of each of these queries so far, of all shards the task has seen, ascending, and is
        raised in place; 0 is no score. Documents that cannot reach them do not appear.
        """
        queries, count, top = self.queries, last - first, self.top
        low, high = queries.offsets[first], queries.offsets[last]
        query = np.repeat(np.arange(count), np.diff(queries.offsets[first : last + 1]))
        place = self.own[queries.place[low:high]]
        query, place = query[place >= 0], place[place >= 0]
        column = self.column[place]
        often = column >= 0
        chosen = np.zeros((count, self.dense.shape[1]), np.float32)
        chosen[query[often], column[often]] = 1
        sizes = self.posting_at[place[~often] + 1] - self.posting_at[place[~often]]
        posting = ranges(self.posting_at[place[~often]], sizes)
        # Postings come query by query, so that the sums of a query stay near each other.
        cell = self.posting_row[posting] + np.repeat(query[~often] * (self.blocks * BLOCK), sizes)
        exact = np.bincount(cell, self.posting_units[posting], minlength=self.blocks * BLOCK * count).astype(float)
        rare = exact.astype(np.float32).reshape(count, self.blocks, BLOCK)
        bounds = chosen @ self.maxima.T + rare.max(axis=2)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for block in np.argsort(-bounds.max(axis=0), kind="stable"):
            least = best[:, 0] * np.float32(1 - MARGIN)
            alive = np.flatnonzero((bounds[:, block] * np.float32(1 + MARGIN) >= least) & (bounds[:, block] > 0))
            if not len(alive):
                continue
            start = block * BLOCK
            scores = chosen[alive] @ self.dense[start : start + BLOCK].T + rare[alive, block]
            who, row = np.nonzero((scores > 0) & (scores * np.float32(1 + 2 * MARGIN) >= best[alive, :1]))
            found.append((alive[who], row + start, scores[who, row]))
            higher = np.flatnonzero(scores.max(axis=1) > best[alive, 0])
            joined = np.concatenate([best[alive[higher]], scores[higher]], axis=1)
            joined = np.partition(joined, joined.shape[1] - top, axis=1)[:, -top:]
            joined.sort(axis=1)
            best[alive[higher]] = joined
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        who, row, score = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = score * np.float32(1 + 2 * MARGIN) >= best[who, 0]
        who, row = who[keep], row[keep]
        if not len(who):
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        exact = exact.reshape(count, -1)[who, row]
        for low in range(0, len(who), EXACT_ROWS):
            part = slice(low, low + EXACT_ROWS)
            exact[part] += np.einsum("ij,ij->i", chosen[who[part]].astype(float), self.whole[row[part]])
        exact = exact.astype(np.int64)
        order = _leading(who, exact, self.shard.null[row], self.shard.ids[row], top)
        return who[order] + first, row[order], exact[order]


def top_documents(docs: DataFrame, wanted: Column, k: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``query_id``, ``rank``, ``doc_id``, ``score``): the ``k`` best rows of ``docs`` for each row where ``wanted`` holds.

    A query is the set of distinct terms of its row's whole text; it is found among the results like any other row. Scores
    are BM25 (k1 1.2, b 0.75, idf ln(1 + (N - n + 0.5) / (n + 0.5))), each term's part rounded to a billionth. Equal scores
    rank by id, null last; rows without a common term do not appear. Null and empty texts have no terms: they find nothing
    and are not found, but count as documents. Repeated rows appear each; queries that repeat an id share their ranks.
    Terms are told apart by 64-bit hashes.
    """
    index = build_index(docs, id_column, text_column)
    size = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    average = size[1] / size[0] if size[0] else 0.0
    found = None
    for ids, rows in _query_blocks(docs, wanted, id_column, text_column):
        terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *rows]))
        counts = _frequencies(index, terms)
        weights = np.log(1 + (size[0] - counts + 0.5) / (counts + 0.5))
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int64)
        place = np.searchsorted(terms, np.concatenate([np.zeros(0, np.uint64), *rows]))
        shared = docs.sparkSession.sparkContext.broadcast(Queries(ids, offsets, place, terms, weights))  # bounded

        def of(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries = shared.value
            best = np.zeros((len(queries.ids), k), np.float32)  # over all shards of the task
            held = [np.zeros(0, np.int64) for _ in range(4)]  # query, units, whether its id is null, id
            for batch in batches:
                for body in batch.column("body"):
                    shard = _load(body.as_py())
                    ready = _Evaluator(shard, queries, average, k)
                    hits = [held]
                    for first in range(0, len(queries.ids), BATCH):
                        last = min(first + BATCH, len(queries.ids))
                        who, row, units = ready.search(first, last, best[first:last])
                        hits.append([who, units, shard.null[row].astype(np.int64), shard.ids[row]])
                    held = [np.concatenate(x) for x in zip(*hits, strict=True)]
                    order = _leading(*held, k)
                    held = [x[order] for x in held]
            who, units, null, ids = held
            names = pa.array(queries.ids, pa.int64()).take(pa.array(who))
            columns = [names, pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(units, pa.int64())]
            table = pa.Table.from_arrays(columns, names=["query_id", "doc_id", "units"])
            yield from table.to_batches(max_chunksize=10_000)

        part = staged(_shared_out(index).mapInArrow(of, "query_id bigint, doc_id bigint, units bigint"), "hits")
        shared.unpersist()
        found = part if found is None else found.union(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("units"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", (F.col("units") / UNIT).alias("score"))

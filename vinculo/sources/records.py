"""Records of quoted text files whose values may hold line breaks, read range by range.

Spark cuts files into byte ranges and reads their lines. Whether a line begins a record depends on the quotes before it
in the whole file: a break inside quotes ends no record. Two passes settle that without giving a file to one task.
The first counts quotes in every range, and keeps the lines before its first and from its last odd line on; the
parities of the ranges, added up along each file, tell which ranges begin inside a record. The second joins lines to
records within each range. What stands across a border is put together from the kept ends, a few lines a range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vinculo.session import staged

LONGEST = 1 << 20  # bytes of a record; a quote left open for longer is an error in the file

ENDS = "file string, block bigint, odd int, whole boolean, head binary, tail binary"
BREAK = b"\n"


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """The stretches of a batch that belong to one range each."""
    block = batch.column("block").to_numpy(zero_copy_only=False)
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True)


def _ends(quote: bytes, longest: int):
    """One row per range: its parity, and the lines up to its first and from its last odd line on."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name: tuple[str, int] | None = None
        odd, head, tail = 0, [], []
        sizes = [0, 0]

        def out() -> pa.RecordBatch:
            texts = [BREAK.join(x)[: longest + 1] for x in (head, tail)]
            row = [[name[0]], [name[1]], [odd % 2], [odd == 0], [texts[0]], [texts[1]]]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["file", "block", "odd", "whole", "head", "tail"])

        def keep(end: int, lines: pa.Array) -> None:
            """Lines for an end, until it is known to be longer than any record."""
            target = (head, tail)[end]
            for line in lines:
                if sizes[end] > longest:
                    return
                target.append(line.as_py())
                sizes[end] += len(target[-1]) + 1

        for batch in batches:
            odds = pc.count_substring(batch.column("value"), quote).to_numpy() % 2
            for low, high in _segments(batch):
                here = (batch.column("file")[low].as_py(), batch.column("block")[low].as_py())
                if here != name:
                    if name is not None:
                        yield out()
                    name, odd, head, tail, sizes = here, 0, [], [], [0, 0]
                lines = batch.column("value").slice(low, high - low)
                at = np.flatnonzero(odds[low:high])
                if odd == 0:
                    keep(0, lines[: at[0] + 1] if len(at) else lines)
                if len(at):
                    tail, sizes[1] = [], 0
                    keep(1, lines[at[-1] :])
                elif odd:
                    keep(1, lines)
                odd += len(at)
        if name is not None:
            yield out()

    return of


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """The records that lines make up, the last of each marked in ``ends``; the breaks between its lines are put back."""
    if ends.all():
        return lines
    broken = pc.binary_join_element_wise(lines, pc.if_else(pa.array(ends), pa.scalar(b""), pa.scalar(BREAK)), pa.scalar(b""))
    _, offsets, data = broken.buffers()
    cuts = np.frombuffer(offsets, np.int32)[broken.offset : broken.offset + len(broken) + 1]
    cuts = np.concatenate((cuts[:1], cuts[1:][ends]))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), data])


def _inner(quote: bytes):
    """The records that begin and end in one range."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, is_open, held = None, False, None  # lines of the record that is open; None if it began in an earlier range
        for batch in batches:
            odds = pc.count_substring(batch.column("value"), quote).to_numpy() % 2
            parts: list[pa.Array] = []
            for low, high in _segments(batch):
                here = (batch.column("file")[low].as_py(), batch.column("block")[low].as_py())
                if here != name:
                    name, is_open, held = here, batch.column("open")[low].as_py(), None
                lines = batch.column("value").slice(low, high - low)
                open_after = (np.cumsum(odds[low:high]) + is_open) % 2 == 1
                closed = np.flatnonzero(~open_after)
                if not len(closed):
                    if not is_open:
                        held = []
                    if held is not None:
                        held += lines.to_pylist()
                    is_open = True
                    continue
                first, last = int(closed[0]) + 1 if is_open else 0, int(closed[-1]) + 1
                if is_open and held is not None:
                    parts.append(pa.array([BREAK.join(held + lines[:first].to_pylist())], pa.binary()))
                parts.append(_joined(lines[first:last], ~open_after[first:last]))
                held = lines[last:].to_pylist()
                is_open = bool(held)
            if parts:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(parts)], names=["value"])

    return of


def read_records(spark: SparkSession, paths: str | Sequence[str], quote: str = '"', glob: str | None = None, longest: int = LONGEST) -> DataFrame:
    """(``value`` binary) of every record of the files: its bytes, without the line break at its end.

    A record ends at a line break (with or without a carriage return) that has an even number of quotes before it in its
    file. Whatever the ranges, the records are the same. Blank records are left out. A file may end inside quotes if what
    follows the last open quote is no longer than ``longest`` bytes; a record beyond that raises an error, since one quote
    too many would otherwise swallow the rest of a file.
    """
    reader = spark.read.option("lineSep", "\n")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths if isinstance(paths, str) else list(dict.fromkeys(paths)))
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )
    ends = lines.mapInArrow(_ends(quote.encode(), longest), ENDS)
    along = Window.partitionBy("file").orderBy("block")  # one row per range of a file
    before = F.coalesce(F.sum("odd").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = staged(ends.withColumn("open", before % 2 == 1), "ranges")
    # One row per range, as many as the driver lists when it plans the scan; a broadcast keeps the lines in order.
    inner = lines.join(F.broadcast(ends.select("file", "block", "open")), ["file", "block"]).mapInArrow(_inner(quote.encode()), "value binary")
    records = inner.unionByName(_across(ends, longest))
    bare = F.expr("CASE WHEN substring(value, -1, 1) = X'0D' THEN substring(value, 1, octet_length(value) - 1) ELSE value END")
    return records.select(bare.alias("value")).where("trim(cast(value AS string)) <> ''")


def _across(ends: DataFrame, longest: int) -> DataFrame:
    """(``value``) of the records that begin in one range and end in another, or at the end of a file that ends in quotes."""
    leaves = (F.col("open").cast("int") + F.col("odd")) % 2 == 1
    pieces = ends.select(
        "file",
        "block",
        F.array(
            F.struct(F.lit(0).alias("end"), F.when(F.col("open"), F.col("head")).alias("body")),
            F.struct(F.lit(1).alias("end"), F.when(leaves & ~F.col("whole"), F.col("tail")).alias("body")),
        ).alias("ends"),
    )
    pieces = pieces.select("file", "block", F.inline("ends")).where("body IS NOT NULL")
    along = Window.partitionBy("file").orderBy("block", "end")
    pieces = pieces.withColumn("record", F.sum("end").over(along))  # a tail begins a record, heads continue it
    gathered = pieces.groupBy("file", "record").agg(
        F.sum(F.octet_length("body")).alias("size"), F.array_sort(F.collect_list(F.struct("block", "end", "body"))).alias("parts")
    )
    fail = F.raise_error(F.concat(F.lit("a quote stays open too long in "), F.col("file")))
    joined = F.aggregate("parts", F.lit(None).cast("binary"), lambda done, x: F.when(done.isNull(), x["body"]).otherwise(F.concat(done, F.lit(BREAK), x["body"])))
    return gathered.select(F.when(F.col("size") > longest, fail.cast("binary")).otherwise(joined).alias("value"))

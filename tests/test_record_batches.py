"""Lines of a range joined to records: many records a batch, without a step of Python for each."""

import random
import time

import pyarrow as pa
import pytest

from vinculo.sources.records import _inner


def batches(ranges, size):
    """Batches of (file, block, open, value) for lists of (block, open, lines)."""
    rows = [("f", block, is_open, line) for block, is_open, lines in ranges for line in lines]
    for low in range(0, len(rows), size):
        columns = zip(*rows[low : low + size], strict=True)
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["file", "block", "open", "value"])


def plain(ranges):
    """The records that begin and end in one range."""
    for _, is_open, lines in ranges:
        held = None if is_open else []
        for line in lines:
            is_open ^= line.count(b'"') % 2 == 1
            if held is not None:
                held.append(line)
            if not is_open:
                if held is not None:
                    yield b"\n".join(held)
                held = []


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_records_of_ranges_against_plain_python(size):
    rng = random.Random(size)
    lines = [b"", b'"', b'a"b"', b'x;"y', b'z"', "ç".encode("latin1"), b'""', b'"""']
    ranges = [(block, rng.random() < 0.4, rng.choices(lines, k=rng.randrange(1, 30))) for block in range(60)]
    found = [value for batch in _inner(b'"')(batches(ranges, size)) for value in batch.column("value").to_pylist()]
    assert found == list(plain(ranges))
    assert len(found) > 200


def test_a_record_costs_no_step_of_its_own():
    lines = [b'"1";"x', b"", b'y";"2"'] * 100_000
    given = list(batches([(0, False, lines)], 10_000))
    began = time.process_time()
    assert sum(batch.num_rows for batch in _inner(b'"')(iter(given))) == 100_000
    assert time.process_time() - began < 0.25

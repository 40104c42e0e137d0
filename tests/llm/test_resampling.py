"""Importance resampling against a plain version."""

from __future__ import annotations

import pytest

from tests.llm import brute
from vinculo.llm import resampling


@pytest.mark.parametrize(("longest", "buckets", "least_words", "percent"), [(1, 10_000, 20, 10), (1, 7, 1, 50), (2, 1000, 5, 100), (3, 50, 0, 33)])
def test_resampling(spark, longest, buckets, least_words, percent):
    rows, targets = brute.odd_rows(), [(1, "The x of, the 1984"), (2, None), (3, "é é Ñandú é"), (4, "")]
    docs = spark.createDataFrame(rows, brute.ODD_SCHEMA).repartition(3)
    target = spark.createDataFrame(targets, "item_id int, text string")
    got = resampling.resample(docs, target, longest, buckets, least_words, percent, seed=9).collect()
    wanted = list(brute.resampled([r[:2] for r in rows], targets, longest, buckets, least_words, percent, 9))
    # Rows that share id and score can take each other's rank.
    assert brute.same([r[:4] for r in got], [r[:4] for r in wanted])
    assert brute.same([(r["doc_id"], r["score"], r["rank"]) for r in got], [(r[0], r[3], r[4]) for r in wanted])


def test_ties_go_to_the_smaller_id_over_many_ranges(spark):
    rows = [(i, 5 if i % 3 else 6, True) for i in range(500)] + [(7, 9, False)]
    frame = spark.createDataFrame(rows, "id bigint, score bigint, eligible boolean").repartition(7)
    from pyspark.sql import functions as F

    got = resampling.draw(frame, 50, F.col("score").desc(), F.col("id").asc_nulls_last()).collect()
    wanted = sorted((r for r in rows if r[2]), key=lambda r: (-r[1], r[0]))[:250]
    assert [(r["id"], r["score"]) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [r[:2] for r in wanted]
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 251))
    assert len(got) == len(rows)


def test_one_row_many_times(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 40, "doc_id bigint, text string")
    got = resampling.resample(docs, docs, least_words=3, percent=25).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11)) and len(got) == 40


def test_nothing(spark):
    docs = spark.createDataFrame([], brute.ODD_SCHEMA)
    some = spark.createDataFrame([(1, "a b " * 30)], "doc_id bigint, text string")
    assert resampling.resample(docs, some).collect() == []
    assert [r["rank"] for r in resampling.resample(some, docs, percent=100).collect()] == [1]

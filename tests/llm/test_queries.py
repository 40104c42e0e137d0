"""The registered queries against their SQL, plain versions and the pipeline's own promises, on the smallest tables."""

from __future__ import annotations

import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.oracle import connect, sorted_rows
from vinculo.llm import queries
from vinculo.session import staged

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    answer = connect(FOLDER).execute(queries.SQL[name])
    assert sorted_rows(frame.columns, frame.collect()) == sorted_rows([x[0] for x in answer.description], answer.fetchall())


def test_thirteen_operators_and_the_pipeline():
    import __spark_entry__ as driver

    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= set(driver.queries())


def test_word_repeats(spark, docs):
    expected = [(*row[:3], sha(row[3])) for row in brute.word_repeats(docs, 13)]
    assert brute.same(queries.QUERIES["op1_recompression"](spark, FOLDER).collect(), expected)


def test_byte_repeats(spark, docs):
    expected = [(*row[:4], sha(row[4])) for row in brute.byte_repeats(docs, 50)]
    assert brute.same(queries.QUERIES["op6_suffix_dedup"](spark, FOLDER).collect(), expected)


def test_near_duplicates(spark, docs):
    assert brute.same(queries.QUERIES["op9_simhash"](spark, FOLDER).collect(), brute.near_groups(docs))


def test_contamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    expected = [(d, n, hit, len(names), sha(",".join(names)), hit > 0) for d, n, hit, names in brute.contaminations(docs, items, 10)]
    assert brute.same(queries.QUERIES["op5_decontamination"](spark, FOLDER).collect(), expected)


def test_secrets(spark, docs):
    def written(spans):
        return ",".join(f"{kind}:{start}:{stop}" for start, kind, stop in spans)

    expected = []
    for doc_id, text in docs:
        spans = brute.secret_spans(text, 200)
        base = [s for s in spans if s[1] in ("assign", "access", "hex")]
        counts = [sum(s[1] == kind for s in base) for kind in ("assign", "access", "hex")]
        expected.append((doc_id, *counts, sha(written(base)), written(spans)))
    assert brute.same(queries.QUERIES["op13_secrets"](spark, FOLDER).collect(), expected)


def test_language_folds(spark):
    rows = queries.QUERIES["op8_language"](spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_pipeline_stage_by_stage(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near-duplicates", "benchmark", "tokens"]
    stages = [given]
    for _, stage in corpus_pipeline.STAGES:
        stages.append(staged(stage(spark, stages[-1], FOLDER)))
    for frame in stages[:-1]:
        assert frame.columns == given.columns
    prose = given.where("length(text) > 200")
    assert stages[1].join(prose, "doc_id", "left_semi").count() >= 0.98 * prose.count()
    after = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert brute.same([(d,) for d, _ in {(d, d) for d, _, c in brute.near_groups(after) if d == c}], [(r["doc_id"],) for r in stages[3].collect()])
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    cleaned = [(r["doc_id"], r["text"]) for r in stages[4].collect()]
    assert not any(row[2] for row in brute.contaminations(cleaned, items, 10))
    tokens = stages[5]
    assert tokens.columns == ["doc_id", "n_tokens", "ids"]
    assert tokens.count() == len(cleaned)
    assert tokens.where(F.size("ids") != F.col("n_tokens")).count() == 0

"""A training-data pipeline of five stages, each applying one operator of ``vinculo.llm`` to all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculo.llm import bpe, decontaminate, language, line_chunks, simhash
from vinculo.session import staged

LEAST_SHARE = 0.25  # of a text's n-grams that its best language must hold


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay.

    The filters are fitted on all labelled documents outside the held-out fold. A document goes if it is null, has no
    letter, or if less than ``LEAST_SHARE`` of its n-grams belong to its best language; one too short to tell stays.
    """
    model = language.train(docs.where(~language.held_out()))
    return language.keep_known(docs, model, LEAST_SHARE)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go, and with them a document of which nothing but blank lines is left."""
    cleaned = line_chunks.remove_repeated(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(line_chunks.SOLID)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).alias("n_chars")
    return cleaned.where(~emptied).select(*[length if name == "n_chars" else F.col(name) for name in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least id."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go; documents that mostly consist of them go whole."""
    cleaned = decontaminate.remove_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, most=0.5)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``ids``) of every document."""
    encoded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", known_languages),
    ("lines", distinct_lines),
    ("near-duplicates", one_of_each_group),
    ("benchmark", without_benchmark),
    ("tokens", token_ids),
]

ORACLE_SQL = None  # language models, fingerprints and automata are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

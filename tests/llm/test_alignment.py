"""Alignment of two tokenizers against the libraries on whole texts and a walk along the bytes."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import brute
from vinculo.llm import alignment
from vinculo.llm.bpe import _byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    tokens = {n: token for token, n in one.get_vocab().items()}
    byte_of = {letter: byte for byte, letter in enumerate(_byte_letters())}
    two = sentencepiece.SentencePieceProcessor(model_file=B)

    def encode_a(text):
        return [(n, bytes(byte_of[c] for c in tokens[n])) for n in one.encode(text, add_special_tokens=False).ids]

    def encode_b(text):
        pieces = [(n, two.id_to_piece(n)) for n in two.encode(text)]
        return [(n, bytes([int(p[3:5], 16)]) if two.is_byte(n) else p.replace("▁", " ").encode()) for n, p in pieces]

    return encode_a, encode_b


def odd_texts():
    """Texts at whose joints the two vocabularies could behave in their own ways."""
    rng = random.Random(3)
    parts = list("ab'sTé. ,\n\t\r_-!中9") + ["  ", "'s", "'ll", "<|endoftext|>", "<s>", "foo", "word", "\U0001f600", "\x00"]
    parts += [chr(n) for n in (0x0B, 0x0C, 0x1C, 0x85, 0xA0, 0x130, 0x2003, 0x200B, 0x2019, 0x2028, 0x2581, 0x3000)]
    return [(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(1500)]


def expected(rows, encoders):
    digest = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute.alignments(rows, *encoders)]
    return digest


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 20])
def test_link_statistics(spark, encoders, block_bytes):
    rows = brute.odd_rows()
    docs = spark.createDataFrame(rows, brute.ODD_SCHEMA).repartition(3)
    got = alignment.link_statistics(docs, A, B, block_bytes=block_bytes).collect()
    assert brute.same(got, expected([r[:2] for r in rows], encoders))


def test_joints_of_stretches(spark, encoders):
    rows = odd_texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert brute.same(alignment.link_statistics(docs, A, B).collect(), expected(rows, encoders))


def test_groups_and_pairs(spark, encoders):
    rows = [r[:2] for r in brute.odd_rows()] + odd_texts()[:50]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = list(brute.alignments(rows, *encoders))
    assert brute.same(alignment.align(docs, A, B).collect(), [(*r[:5], r[7]) for r in wanted])
    pairs = alignment.pair_counts(docs, A, B).collect()
    assert sum(r["n"] for r in pairs) == sum(r[4] for r in wanted)
    most = {}
    for r in pairs:
        most[r["b"]] = max(most.get(r["b"], 0), r["n"])
    assert all(r["best"] == (r["n"] == most[r["b"]]) for r in pairs)
    assert len({(r["a"], r["b"]) for r in pairs}) == len(pairs)


def test_what_is_remembered_changes_nothing(spark, encoders, monkeypatch):
    rows = odd_texts()[:400]
    lexicon = alignment.Lexicon(alignment.sides(A, B))
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    found = []
    for i in range(0, len(rows), 7):
        piece = alignment.Piece([t for _, t in rows[i : i + 7]], lexicon)
        found += list(zip(map(tuple, piece.figures.tolist()), piece.spelt, strict=True))
    assert found == [(r[1:5], r[7]) for r in brute.alignments(rows, *encoders)]


def test_vocabularies_that_merge_everywhere_are_not_cut():
    both = alignment.Sides(A, B)
    both._places(["ab", "b▁c"])
    assert both.words is None and both.stretches("ab c") == [" ab c"]
    both._places(["ab", "b.", "▁c"])
    assert both.stretches("ab. c") == [" ab.", " c"]


def test_pointers_reach_the_end_of_a_long_group():
    # Tokens of two bytes against tokens of two bytes shifted by one: one group over the whole length.
    ends_a, ends_b = np.append(np.arange(2, 20_001, 2), 20_001), np.arange(1, 20_002, 2)
    assert set(alignment.last_of_group(ends_a, ends_b).tolist()) == {len(ends_b) - 1}


def test_nothing(spark):
    docs = spark.createDataFrame([], brute.ODD_SCHEMA)
    assert alignment.link_statistics(docs, A, B).collect() == []
    assert alignment.align(docs, A, B).collect() == []
    assert alignment.pair_counts(docs, A, B).collect() == []

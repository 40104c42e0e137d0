"""The operators against plain versions, on rows that are hard on them."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from vinculo.llm import arrays, bpe, decontaminate, language, line_chunks, range_coder, recompression, search, simhash, suffix_dedup, token_files, url_models
from vinculo.session import scratch_path

WORD_BPE, BYTE_BPE = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.odd_rows(), brute.ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def pairs():
    return [row[:2] for row in brute.odd_rows()]


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], brute.ODD_SCHEMA)


def thue_morse(swapped=False):
    """1024 letters whose complement has the same value under every polynomial hash modulo 2**64."""
    return "".join("ab"[(bin(i).count("1") + swapped) % 2] for i in range(1024))


def test_words_that_collide_under_polynomials(spark):
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{thue_morse()} {rest}"), (2, f"{thue_morse(True)} {rest}"), (50, thue_morse()), (51, thue_morse(True)), (53, f"x {thue_morse()}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert brute.same(recompression.remove_repeats(docs, 13).collect(), brute.word_repeats(rows, 13))
    found = search.top_documents(docs, F.col("doc_id") == 50, k=10).collect()
    assert {r["doc_id"] for r in found} == {1, 50, 53}


@pytest.mark.parametrize("longest", [3, 20, 600, 40_000])
def test_string_hashes(longest):
    rng = random.Random(longest)
    texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(longest))) for _ in range(60)]
    texts += [t[:-1] for t in texts] + [t + b"\0" for t in texts] + texts
    at = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    one, two = (arrays.string_hashes(data, at[:-1], at[1:], seed) for seed in (0, 7))
    for hashes in (one, two):
        assert len(set(hashes.tolist())) == len(set(texts)) == len(set(zip(texts, hashes.tolist(), strict=True)))
    assert not set(one.tolist()) & set(two.tolist())


def mixture(seed, letters, count=60):
    """Texts that share stretches at many offsets."""
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(count // 2)]
    return [(i, (b := rng.choice(base))[rng.randrange(len(b) + 1) :] + rng.choice(base)[:70]) for i in range(count)]


# --- substring dedup ----------------------------------------------------------------------------------


@pytest.mark.parametrize("window", [1, 4, 13])
def test_word_repeats(odd, pairs, window):
    got = recompression.remove_repeats(odd, window, block_bytes=500).collect()
    assert brute.same(got, brute.word_repeats(pairs, window))


@pytest.mark.parametrize(("letters", "window"), [("a ", 5), ("ab ", 4), ("abc  ", 7)])
def test_word_repeats_of_mixtures(spark, letters, window):
    rows = mixture(window, letters)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert brute.same(recompression.remove_repeats(docs, window, block_bytes=300).collect(), brute.word_repeats(rows, window))


@pytest.mark.parametrize(("length", "hot"), [(50, 40_000), (50, 2), (13, 3)])
def test_byte_repeats(odd, pairs, length, hot):
    got = suffix_dedup.remove_repeats(odd, length, block_bytes=2000, hot=hot).collect()
    assert brute.same(((*r[:4], bytes(r[4])) for r in got), brute.byte_repeats(pairs, length))


def test_a_crowded_window_is_an_entry_per_block():
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefghij ", k=90))
    around = lambda: "".join(rng.choices("klmnopqrst", k=40))
    blocks = [pa.table({"id": [10 * b + i for i in range(10)], "text": [around() + passage + around() for _ in range(10)]}) for b in range(3)]

    def of(table, block):
        return table.filter(pa.array([x == block for x in table.column("block").to_pylist()], pa.bool_()))

    anchors = pa.concat_tables(suffix_dedup._send_anchors(b, docs, 50, 1) for b, docs in enumerate(blocks))
    shared = suffix_dedup.share_codes(0, anchors, 5)
    names = pa.concat_tables(suffix_dedup._send_names(b, docs, of(shared, b), 50, 1) for b, docs in enumerate(blocks))
    asked = suffix_dedup._ask(0, names)
    sent = pa.concat_tables(suffix_dedup._send_bytes(b, docs, of(asked, b), 50, 1) for b, docs in enumerate(blocks))
    copies = Counter()
    for payload in sent.column("payload").to_pylist():
        data = suffix_dedup.unpress(payload, [np.uint64, np.uint64, np.int64, np.uint64, np.uint8])[-1].tobytes()
        copies.update(data[i : i + 50] for i in range(len(data) - 49))
    assert max((copies[passage[i : i + 50].encode()] for i in range(41)), default=0) <= len(blocks)
    _, (name, anchor, _) = suffix_dedup.unpack(names, 3)
    assert max(Counter(zip(name.tolist(), (anchor >> np.uint64(2)).tolist(), strict=True)).values()) == len(blocks)


@pytest.mark.parametrize(("letters", "length", "hot"), [("a", 50, 3), ("ab", 21, 40_000), ("abé", 30, 3)])
def test_byte_repeats_of_mixtures(spark, letters, length, hot):
    rows = mixture(length, letters)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(docs, length, block_bytes=1000, hot=hot).collect()
    assert brute.same(((*r[:4], bytes(r[4])) for r in got), brute.byte_repeats(rows, length))


def test_suffixes_sort_like_bytes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    starts = np.arange(len(data) - 30)
    order, number = suffix_dedup.Suffixes(data, 30).classes(starts)
    strings = [data[s : s + 30].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(strings, strings[1:])] == (np.diff(number) == 0).tolist()  # noqa: B905


def test_a_collision_is_found(monkeypatch):
    data = np.frombuffer(b"abcdefgh" * 20 + b"abcdefgx" * 20, np.uint8)
    suffixes = suffix_dedup.Suffixes(data, 16)
    monkeypatch.setattr(suffixes, "common", lambda one, two: np.full(len(one), 16))  # everything collides
    starts = np.array([0, 8, 160, 168])
    order, number = suffixes.classes(starts)
    assert [set(starts[order][number == n]) for n in (0, 1)] == [{0, 8}, {160, 168}]


# --- near duplicates ----------------------------------------------------------------------------------


@pytest.mark.parametrize("tile", [2, 32_768])
def test_near_duplicates(odd, pairs, tile):
    assert brute.same(simhash.near_duplicates(odd, tile=tile).collect(), brute.near_groups(pairs))


def test_chains_of_fingerprints(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(300):
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [p - (1 << 64) if p >> 63 else p for p in set(prints)]
    nodes = spark.createDataFrame([(p,) for p in signed], "bits bigint")
    links = simhash.components(simhash.fingerprint_links(nodes, 3, tile=16)).collect()
    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(signed):
        for q in signed[:i]:
            if ((p ^ q) & (2**64 - 1)).bit_count() <= 3:
                a, b = find(p), find(q)
                root[max(a, b)] = min(a, b)
    assert {r["node"]: r["component"] for r in links} == {p: find(p) for p in signed if find(p) != p}


def test_one_of_each_group_stays(odd, pairs):
    stays = {row[0] for row in brute.near_groups(pairs) if row[0] == row[2]}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == stays | {None}


# --- lines --------------------------------------------------------------------------------------------


def plain_line_repeats(pairs):
    """(id, text, lines, lines removed) of every row by the rule as stated, rows that share an id at the same places."""

    def solid(text):
        return [(i, line) for i, line in enumerate(text.split("\n")) if line.strip(" \t\n\v\f\r")]

    first = {}
    for doc_id, text in pairs:
        if doc_id is not None and text is not None:
            found = solid(text)
            for k, ((_, a), (_, b)) in enumerate(zip(found, found[1:])):  # noqa: B905
                first[a, b] = min(first.get((a, b), (float("inf"), 0)), (doc_id, k))
    for doc_id, text in pairs:
        lines = [] if text is None else text.split("\n")
        gone = set()
        if doc_id is not None and text is not None:
            found = solid(text)
            for k, ((start, a), (stop, b)) in enumerate(zip(found, found[1:])):  # noqa: B905
                if first[a, b][0] < doc_id or first[a, b][1] < k - 1:
                    gone |= set(range(start, stop + 1))
        kept = text if not gone else "\n".join(line for i, line in enumerate(lines) if i not in gone)
        yield doc_id, kept, len(lines), len(gone)


def test_repeated_lines(odd, pairs):
    got = line_chunks.remove_repeated(odd)
    assert got.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert brute.same(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()), plain_line_repeats(pairs))


LINES = [(i, "\n".join(random.Random(i).choices(["a b", "c", "", " \t", "d e f", "g", "h", "i j"], k=i % 13))) for i in range(60)]
LINES += [(7, "a b\nc\nnew\nd e f\ng"), (None, "a b\nc"), (61, None), (62, ""), (63, "x\nx\nx"), (64, "y\ny\ny\ny"), (65, "\n\nq\n\nr"), (66, "q\nr\n")]


@pytest.mark.parametrize("colliding", [False, True])
def test_short_passages(spark, monkeypatch, colliding):
    """Every passage of two lines or more, with blank lines, repeats within a document and texts of one id."""
    if colliding:  # names of a few bits: the bytes decide
        gaps = line_chunks.gaps
        monkeypatch.setattr(line_chunks, "gaps", lambda *given: gaps(*given).withColumn("name", F.pmod("name", F.lit(3))))
    docs = spark.createDataFrame(LINES, "doc_id bigint, text string")
    got = line_chunks.remove_repeated(docs).collect()
    assert brute.same((tuple(r) for r in got), plain_line_repeats(LINES))


def test_planted_passages(spark):
    """Passages of 2 to 5 lines at the top, in the middle and at the end of unlike documents; clean lines stay."""
    rng = random.Random(5)
    rows, planted = [], {}
    for i in range(200):
        passage = [f"passage {i % 40} line {n} of it" for n in range(2 + i % 4)]
        own = [f"line {rng.random()}" for _ in range(6)]
        cut = (0, 3, 6)[i % 3]
        rows.append((i, "\n".join(own[:cut] + passage + own[cut:])))
        planted[i] = ("\n".join(own), len(passage)) if i >= 40 else (rows[-1][1], 0)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_chunks.remove_repeated(docs).collect()} == planted


def test_chunks_survive_insertions(spark):
    rng = random.Random(8)
    lines = [f"line {rng.random()}" for _ in range(200)]
    shifted = ["new", *lines[:90], "also new", *lines[91:]]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(shifted))], "doc_id bigint, text string")
    removed = {r["doc_id"]: r["n_removed"] for r in line_chunks.remove_repeated(docs).collect()}
    assert removed == {1: 0, 2: 199}


# --- benchmark passages -------------------------------------------------------------------------------


def spans_as_counts(frame):
    for row in frame.collect():
        yield row["doc_id"], row["n_words"], sum(s["high"] - s["low"] for s in row["spans"]), row["items"]


@pytest.mark.parametrize("window", [2, 5, 10])
def test_contamination(spark, odd, pairs, window, monkeypatch):
    items = [(1, pairs[9][1]), (2, "X x"), (3, None), (4, ""), (5, "the of"), (None, "Word é"), (1, pairs[7][1]), (6, "don't 1984")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    expected = list(brute.contaminations(pairs, items, window))
    assert brute.same(spans_as_counts(decontaminate.contamination(odd, frame, window)), expected)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 100)  # several passes
    assert brute.same(spans_as_counts(decontaminate.contamination(odd, frame, window)), expected)


def test_no_items(spark, odd, pairs):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert all(row[2] == 0 and not row[3] for row in spans_as_counts(decontaminate.contamination(odd, empty)))
    assert brute.same((r[:2] for r in decontaminate.remove_passages(odd, empty).collect()), pairs)


def test_passages_are_removed(spark):
    words = [f"w{i}" for i in range(40)]
    item = spark.createDataFrame([(1, " ".join(words[:15]))], "item_id bigint, text string")
    rows = [
        (1, "Before. " + " ".join(words[:12]) + " after these words and more than enough of them to keep the document whole"),
        (2, " ".join(words[:14])),  # nothing else
        (3, " ".join(words[:9])),  # too short
        (4, "a b c d e f g h i j k l " + " ".join(words[:5]) + " " + " ".join(words[:11]) + " " + " ".join(words[5:10])),  # meets over the cut
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"]: r["text"] for r in decontaminate.remove_passages(docs, item).collect()}
    assert set(kept) == {1, 3, 4}
    assert kept[1].startswith("Before. \n after")
    assert kept[3] == rows[2][1]
    assert not any(r[2] for r in brute.contaminations(kept.items(), [(1, " ".join(words[:15]))], 10))


@pytest.mark.parametrize("most", [0.5, 1.0])
def test_shards_do_not_change_what_is_removed(spark, most, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    filler = [f"other{i}" for i in range(20)]
    items = [(i, " ".join(words[i : i + 10])) for i in range(0, 21, 3)]  # overlap each other
    texts = [words[:15] + filler, words[3:23], filler[:5] + words[:12] + filler[5:9] + words[18:], words[:4] + words[9:19] + words[4:10] + filler]
    texts += [rng.choices([words[3:13], words[6:16], words[:6], words[6:10], filler[:4]], k=rng.randrange(1, 6)) for _ in range(40)]
    texts = [x if isinstance(x[0], str) else sum(x, []) for x in texts]
    rows = [(i, i % 3, " ".join(x)) for i, x in enumerate(texts)] + [(0, 7, None), (None, 8, ""), (None, 9, " ".join(texts[0]))]
    docs = spark.createDataFrame(rows, "t bigint, spans int, text string")  # names used inside
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    expected = decontaminate.remove_passages(docs, frame, most=most).collect()
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 100)
    got = decontaminate.remove_passages(docs, frame, most=most)
    assert got.columns == docs.columns
    assert brute.same(got.collect(), expected)
    assert not any(row[2] for row in brute.contaminations([(r["t"], r["text"]) for r in expected], items, 10))


# --- byte-pair encoding -------------------------------------------------------------------------------


def test_round_trip_equals_the_library(odd, pairs):
    import hashlib

    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for doc_id, text in pairs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digests = (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
        expected.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in digests)))
    assert brute.same(bpe.round_trip(odd, WORD_BPE).collect(), expected)


def test_random_texts_equal_the_library():
    rng = random.Random(2)
    letters = "aaabbcde  '\n\t019éßñΣσİıǅ中文カ\U0001f600<|endoftext|>\u200d ſK don't 'S\x1c\x85"
    texts = ["".join(rng.choice(letters) if rng.random() < 0.9 else chr(rng.randrange(32, 0x3000)) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["x <|ENDOFTEXT|> y", "<|startoftext|><|endoftext|>", "ab" * 2000, "a" * 999]
    words, library = bpe.Encoder(bpe.vocabulary(WORD_BPE)), Tokenizer.from_file(WORD_BPE)
    assert words(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    bytes_, library = token_files.Tokens(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    assert bytes_(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"word{i} other{i % 7}" for i in range(200)]
    expected = bpe.Encoder(bpe.vocabulary(WORD_BPE))(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(bpe.vocabulary(WORD_BPE))
    assert [encoder([t])[0] for t in texts] == expected


# --- token files --------------------------------------------------------------------------------------


def test_token_files(spark, odd, pairs, nothing):
    library = Tokenizer.from_file(BYTE_BPE)
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(odd, folder, BYTE_BPE)
    ids = defaultdict(list)
    for doc_id, text in pairs:
        ids[doc_id].append(library.encode(text or "", add_special_tokens=False).ids + [0])
    read = defaultdict(list)
    for row in token_files.read_ids(spark, folder).collect():
        read[row["doc_id"]].append(row["ids"])
    assert {k: sorted(v) for k, v in ids.items()} == {k: sorted(v) for k, v in read.items()}
    rows = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in pairs), key=lambda d: -(2**63) if d is None else d)
    start = 0
    for row in rows:
        assert row["start"] == start
        start += row["n_tokens"]
        assert row["ids_crc32"] in {zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids[row["doc_id"]]}
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(nothing, folder, BYTE_BPE)
    assert token_files.read_documents(spark, folder).count() == 0


def test_frames_round_trip_and_check(monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK", 64)
    rng = np.random.default_rng(5)
    ids = [np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32) for n in (0, 1, 63, 64, 65, 1000)] + [np.full(500, 70_000, np.uint32)]
    body = token_files.write_frame([None, *range(6)], ids)
    names, offsets, flat = token_files.read_frame(body)
    assert names == [None, *range(6)]
    assert np.array_equal(flat, np.concatenate(ids))
    assert np.diff(offsets).tolist() == [len(x) for x in ids]
    monkeypatch.setattr(zlib, "crc32", lambda _, crc32=zlib.crc32: crc32(b""))
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_frame(body)


def test_words_started_anew_change_nothing(monkeypatch):
    texts = [f"word{i} other{i % 7}" for i in range(200)]
    expected = token_files.Tokens(BYTE_BPE)(texts)
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 10)
    tokens = token_files.Tokens(BYTE_BPE)
    assert [tokens([t])[0] for t in texts] == expected
    assert len(tokens.known) < 20


def test_words_end_where_the_library_ends_them():
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'LL", "'v", "a", "bc", "é", "12", "²", "!", "..", "\u00a0", "’", "<|endoftext|>", "日本", "\u0085", "<|", "l", "\0"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)] + ["", "'", "'s", "a'", "'l"]
    library = Tokenizer.from_file(BYTE_BPE)
    expected = [row.ids for row in library.encode_batch(texts, add_special_tokens=False)]
    for size in (3, 3005):
        tokens = token_files.Tokens(BYTE_BPE)
        for low in range(0, len(texts), size):
            ids, at = tokens.encode(pa.array(texts[low : low + size]))
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == expected[low : low + size]


@pytest.mark.parametrize("skew", [1.02, 1.05])
def test_frames_are_smaller_than_the_entropy_of_their_blocks_with_alphabets(skew):
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(skew, 200_000), 50_000).astype(np.uint32)
    body = token_files.write_frame([1], [ids])
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert len(body) * 8 < 1.05 * len(ids) * -(share * np.log2(share)).sum() + 20 * len(share) + 64 * len(ids) / range_coder.BLOCK


@pytest.mark.parametrize("shared", [[1, 5, 100, 3], [10**6, 1], [7]])
def test_range_coder_with_shares(shared):
    rng = np.random.default_rng(len(shared))
    order0 = range_coder.shares(np.array(shared))
    assert order0.sum() == 1 << 20 and order0.min() >= 1
    lengths = np.array([3000, 3000, 17])
    places = rng.integers(1, len(shared) + 1, (3, 3000)).astype(np.uint32)
    places[2, 17:] = 0
    words = range_coder.encode(places, lengths, np.full(3, len(shared)), order0)
    assert np.array_equal(range_coder.decode(words, lengths, np.full(3, len(shared)), order0), places)


@pytest.mark.parametrize("alphabet", [1, 2, 30, 5000])
def test_range_coder(alphabet):
    rng = np.random.default_rng(alphabet)
    lengths = np.array([300, 300, 300, 17])
    places, sizes = np.zeros((4, 300), np.uint16), np.zeros(4, np.int64)
    for lane, n in enumerate(lengths):
        letters, place = np.unique(np.minimum(rng.zipf(1.2, n), alphabet), return_inverse=True)
        places[lane, :n], sizes[lane] = place + 1, len(letters)
    words = range_coder.encode(places, lengths, sizes)
    assert np.array_equal(range_coder.decode(words, lengths, sizes), places)
    alone = range_coder.encode(places[1:2], lengths[1:2], sizes[1:2])  # blocks do not depend on each other
    assert len(alone[0]) == len(words[1])


# --- language -----------------------------------------------------------------------------------------


def test_language(spark, odd, nothing):
    folder = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(folder)
    model = language.train(docs.where(~language.held_out()))
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out())
    wrong = found.where("lang <> lang_pred").count()
    assert wrong <= 0.02 * found.count()
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert 0 <= row["score"] <= 1
        assert row["lang_pred"] in {"de", "en", "es", "fr", "und"}
    unlettered = odd.where("text is null or not text rlike '[\\\\p{L}]'")
    assert {r["lang_pred"] for r in language.predict(unlettered, model).collect()} == {"und"}
    assert language.predict(nothing, model).count() == 0


def plain_languages(learned, texts, slot_bits, probes):
    """Best language and score by plain sets: n-grams counted in Python, a set of slots for each language."""

    def grams(text):
        kept = bytearray(b" ")
        for byte in text.encode().lower():  # of bytes, so A-Z alone
            if 0x61 <= byte <= 0x7A or byte >= 0x80:
                kept.append(byte)
            elif kept[-1] != 0x20:
                kept += b" "
        kept += b"" if kept[-1] == 0x20 else b" "
        return [int.from_bytes(kept[i : i + 4], "big") for i in range(len(kept) - 3)]

    def slots(gram):
        h = int(arrays.mixed(np.array([gram + 1], dtype=np.uint64))[0])
        return [((h >> 32) + probe * ((h & 0xFFFFFFFF) | 1)) % 2**slot_bits for probe in range(probes)]

    counts = {}
    for lang, text in learned:
        counts.setdefault(lang, Counter()).update(grams(text))
    share = {lang: {g: n / own.total() for g, n in own.items()} for lang, own in counts.items()}
    filled = {lang: set() for lang in sorted(counts)}
    for lang in filled:
        for gram, own in share[lang].items():
            mean = sum(other.get(gram, 0) for other in share.values()) / len(share)
            if own > mean * (1 + 1e-12):
                filled[lang].update(slots(gram))
    for text in texts:
        own = [slots(g) for g in grams(text)]
        corrected = []
        for lang, bits in filled.items():
            chance = (len(bits) / 2**slot_bits) ** probes
            hits = sum(all(s in bits for s in each) for each in own) / max(len(own), 1)
            corrected.append(min(1, max(0, (hits - chance) / (1 - chance))))
        yield list(filled)[corrected.index(max(corrected))], max(corrected) / (sum(corrected) or 1)


@pytest.mark.parametrize("slot_bits", [9, 16])
def test_language_equals_plain_sets(spark, slot_bits):
    rng = random.Random(12)
    syllables = {"aa": ["ka", "to", "mi", "re"], "bb": ["zu", "mi", "ör", "xe"], "cc": ["ka", "ñu", "li", "pe"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 5))) for _ in range(n)) + rng.choice(["", ".", " 12 A"])

    learned = [(lang, text(lang, 30)) for lang in syllables for _ in range(8)]
    texts = [text(lang, n) for lang in syllables for n in (1, 3, 10, 40)] + ["", "q"]
    docs = spark.createDataFrame(learned, "lang string, text string")
    model = language.train(docs, slot_bits=slot_bits, most_slot_bits=slot_bits)
    assert model.masks.shape[0] == 2**slot_bits
    rows = language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    for i, (lang, value) in enumerate(plain_languages(learned, texts, slot_bits, 3)):
        if texts[i]:
            assert got[i] == (lang, pytest.approx(value))


def test_filter_grows_with_its_grams():
    assert language._slot_bits(0, 18, 22) == 18
    assert language._slot_bits(100_000, 18, 22) == 21
    assert language._slot_bits(10**9, 18, 22) == 22


def test_no_language_learned(odd, nothing):
    model = language.train(nothing)
    assert model.languages == []
    assert {r["lang_pred"] for r in language.predict(odd, model).collect()} == {"und"}


def test_filters_hold_what_was_admitted():
    grams = np.arange(5000, dtype=np.uint32) * 977
    masks = np.zeros((1 << 14, 2), np.uint64)
    for slots in language._slots(grams[:1000], 14, 3):
        masks[slots, 1] |= np.uint64(1 << 5)
    model = language.Model([f"l{i:02d}" for i in range(70)], masks, 3)
    assert model.false_positives()[69] > 0
    assert model.false_positives()[0] == 0
    shares, counts = language.score(pa.array(["no such grams", "", None]), model)
    assert shares.shape == (3, 70)
    assert counts.tolist() == [12, 0, 0]


# --- urls ---------------------------------------------------------------------------------------------

RULES = (url_models.Rule("allow", "org", "/"), url_models.Rule("block", "example.org", "/es/"), url_models.Rule("block", "example.org", "/en/1"))


def test_url_parts_and_rules(spark):
    cases = [
        (None, "", "", None),
        ("", "", "", None),
        ("no scheme/path", "", "", None),
        ("http://", "", "", None),
        ("http://A.Org", "a.org", "", None),
        ("http://A.Org/", "a.org", "/", "org/"),
        ("HTTPS://x.example.ORG/es/1?q#f", "x.example.org", "/es/1", "example.org/es/"),
        ("x://notexample.org/es/", "notexample.org", "/es/", "org/"),
        ("x://example.org/en/2", "example.org", "/en/2", "org/"),
        ("x://example.org/en/1", "example.org", "/en/1", "example.org/en/1"),
        ("a://b://c/d", "b:", "//c/d", None),
        ("x://É.org?y/z", "É.org", "", None),
        ("x://h\n.net/p\n#x", "h\n.net", "/p\n", None),
        ("\u0002\u0002://a.org/\u0003?\u0002", "a.org", "/\u0003", "org/"),  # the marks of start and end
        ("x://long.net/" + "p" * 200_000 + "?" + "q" * 200_000, "long.net", "/" + "p" * 200_000, None),
    ]
    pages = spark.createDataFrame([(i % 5, c[0], "html", 1) for i, c in enumerate(cases)] * 2, "page_id bigint, url string, html string, row int")
    rows = url_models.judge(pages, RULES).collect()
    expected = Counter((i % 5, *c[1:]) for i, c in enumerate(cases))
    assert Counter(r[:4] for r in rows) == Counter({k: 2 * v for k, v in expected.items()})
    assert all(r["verdict"] in ("allow", "block") for r in rows)
    assert url_models.judge(pages.limit(0), RULES).count() == 0
    assert {r["verdict"] for r in url_models.judge(pages, ()).collect()} == {"allow"}  # nothing learned


def test_url_models_learn(spark):
    good = [(i, f"http://a.org/news/{i}") for i in range(60)] + [(i, f"http://b.net/news/{i}") for i in range(60, 90)]
    bad = [(i, f"http://c.com/zzqx/{i}") for i in range(100, 160)] + [(i, f"http://d.net/zzqx/{i}") for i in range(160, 190)]
    rules = (url_models.Rule("allow", "org", "/"), url_models.Rule("block", "com", "/"))
    pages = spark.createDataFrame(good + bad, "page_id bigint, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_models.judge(pages, rules).collect()}
    assert all(verdicts[i] == ("allow" if i < 100 else "block") for i in verdicts)


def test_url_models_read_what_follows_the_path(spark):
    rules = (url_models.Rule("allow", "org", "/"), url_models.Rule("block", "com", "/"))
    pages = [(i, f"http://{'abcdefgh'[i % 8]}.{zone}/x?{query}={i}#{query}") for zone, query in (("org", "id"), ("com", "zzqx")) for i in range(80)]
    pages += [(1000, "http://q.net/x?id=4#id"), (1001, "http://q.net/x?zzqx=4#zzqx"), (1002, "id=5#id"), (1003, "zzqx=5#zzqx")]
    verdicts = {r["page_id"]: r["verdict"] for r in url_models.judge(spark.createDataFrame(pages, "page_id bigint, url string"), rules).collect()}
    assert [verdicts[i] for i in range(1000, 1004)] == ["allow", "block", "allow", "block"]


@pytest.mark.parametrize("hot", [1, 30])
def test_frequent_grams_do_not_change_scores(spark, monkeypatch, hot):
    pages = spark.createDataFrame([(i, f"http://{'ab'[i % 2]}.{('org', 'net')[i % 2]}/{i * i}") for i in range(60)], "page_id bigint, url string")
    expected = {r["page_id"]: r["score"] for r in url_models.judge(pages, RULES).collect()}
    monkeypatch.setattr(url_models, "HOT", hot)  # none or few of the n-grams are broadcast
    assert {r["page_id"]: r["score"] for r in url_models.judge(pages, RULES).collect()} == pytest.approx(expected)


# --- search -------------------------------------------------------------------------------------------


def test_search_equals_exhaustive_scores(spark, odd, pairs, monkeypatch):
    import math

    terms = [Counter(brute.LETTERS_AND_DIGITS.findall(brute.lowered(text))) for _, text in pairs]
    size, average = len(pairs), sum(sum(t.values()) for t in terms) / len(pairs)
    seen = Counter(w for t in terms for w in t)

    def part(word, doc):
        idf = math.log(1 + (size - seen[word] + 0.5) / (seen[word] + 0.5))
        tf, long = doc[word], sum(doc.values()) / average
        return round(idf * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * long))) * 1e9)

    wanted = {13, 93, 103, 123, 153}
    expected = defaultdict(list)
    for (query_id, _), query in zip(pairs, terms, strict=True):
        if query_id in wanted:
            hits = [(-sum(part(w, doc) for w in query if w in doc), brute.order(doc_id)) for (doc_id, _), doc in zip(pairs, terms, strict=True) if set(query) & set(doc)]
            expected[query_id] += hits
    got = defaultdict(list)
    for row in search.top_documents(odd, F.col("doc_id").isin(*wanted), k=4).collect():
        got[row["query_id"]].append((row["rank"], -round(row["score"] * 1e9), brute.order(row["doc_id"])))
    for query_id in wanted:
        best = sorted(expected[query_id])[:4]
        ours = [(score, doc) for _, score, doc in sorted(got[query_id])]
        assert [doc for _, doc in ours] == [doc for _, doc in best]
        assert all(abs(a[0] - b[0]) <= 2000 for a, b in zip(ours, best, strict=True))


def test_search_keeps_the_best_of_earlier_shards():
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    texts[150:200] = texts[:50]  # equal scores in two shards
    shards = [search._shard(pa.table({"id": list(range(low, low + 150)), "t": texts[low : low + 150]})) for low in (0, 150)]
    terms, bounds = search._terms(pa.array(texts[:40]))
    rows = [np.unique(terms[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    known = np.unique(np.concatenate(rows))
    spread = np.array([sum(int(t in s.vocabulary) * int((s.place == np.searchsorted(s.vocabulary, t)).sum()) for s in shards) for t in known])
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    weights = np.log(1 + (300 - spread + 0.5) / (spread + 0.5))
    queries = search.Queries(list(range(40)), offsets, np.searchsorted(known, np.concatenate(rows)), known, weights)
    average = float(np.concatenate([s.lengths for s in shards]).mean())
    ready = [search._Evaluator(s, queries, average, 5) for s in shards]

    def hits(states):
        found = []
        for one, best in zip(ready, states, strict=True):
            who, row, score = one.search(0, 40, best)
            found.append(list(zip(who.tolist(), (-score).tolist(), one.shard.ids[row].tolist(), strict=True)))
        return found

    def best_of(found):
        ranked = sorted(found[0] + found[1])
        return [[hit for hit in ranked if hit[0] == q][:5] for q in range(40)]

    apart = hits([np.zeros((40, 5), np.float32) for _ in shards])
    shared = np.zeros((40, 5), np.float32)
    together = hits([shared, shared])
    assert best_of(together) == best_of(apart)
    assert len(together[1]) < len(apart[1])
    words = [Counter(t.split()) for t in texts]
    for query, score, doc in together[0] + together[1]:
        parts = {w: math.log(1 + (300 - n + 0.5) / (n + 0.5)) for w in set(texts[query].split()) & set(words[doc]) for n in [sum(w in x for x in words)]}
        long = 1.2 * (0.25 + 0.75 * sum(words[doc].values()) / average)
        assert abs(-score - sum(round(idf * words[doc][w] * 2.2 / (words[doc][w] + long) * 1e9) for w, idf in parts.items())) <= len(parts)


def test_search_without_terms(spark, odd, nothing):
    assert search.top_documents(odd, F.col("doc_id") == 3).count() == 0  # a null text
    assert search.top_documents(nothing, F.lit(True)).count() == 0


# --- empty tables -------------------------------------------------------------------------------------


def test_empty_tables(spark, nothing):
    items = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    frames = [
        recompression.remove_repeats(nothing),
        suffix_dedup.remove_repeats(nothing),
        simhash.near_duplicates(nothing),
        simhash.keep_one(nothing),
        line_chunks.remove_repeated(nothing),
        decontaminate.contamination(nothing, items),
        decontaminate.remove_passages(nothing, items),
        bpe.encode(nothing, WORD_BPE),
        bpe.round_trip(nothing, WORD_BPE),
    ]
    assert [frame.count() for frame in frames] == [0] * len(frames)

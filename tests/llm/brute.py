"""Plain versions of the operators, and rows that are hard on all of them."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash

from vinculo.llm import secrets

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LETTERS_AND_DIGITS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

ODD_SCHEMA = "doc_id bigint, text string, id bigint, gone string, n_lines string, block int, lang string"


def odd_rows(seed: int = 1) -> list[tuple]:
    """Null ids and texts, empty and long texts, ties, repeated rows, shared passages, and columns with awkward names."""
    rng = random.Random(seed)
    words = ["the", "of", "é", "ñandú", "x", "Word", "中文", "1984", "don't", "a-b"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = "\n".join(prose(9) for _ in range(9))
    texts = [None, "", " ", "\n\n", "x", "x", prose(3), prose(12), prose(13), passage, passage, passage + "\nmore", prose(4) + "\n" + passage]
    texts += ["the " * 40, "a" * 200, "the " * 41, prose(6000), "!!! ???", "tab\tand\r\nbreak\x0bhere", "<|endoftext|> end", "\U0001f600 \u0301 İ ǅ"]
    texts += [passage[:200] + prose(30), prose(30) + passage[-220:], "\n".join(["same line"] * 12), "\n".join(["same line"] * 12)]
    rows = [(10 * i + 3, text, i % 2, "g", "n", 7, "en") for i, text in enumerate(texts)]
    rows += [(None, passage, 1, None, None, None, None), (None, None, None, None, None, None, None), (None, "x", 1, "", "", 0, "fr")]
    rows += [rows[9], rows[9], (rows[9][0], "another text under the id", 1, "g", "n", 7, "de"), (-5, passage[100:], 0, "g", "n", 1, "es")]
    return rows


def order(doc_id):
    return float("inf") if doc_id is None else doc_id


def words_of(text):
    return WORD.findall((text or "").encode())


def lowered(text):
    return (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


def covered(docs, size, parts):
    """Per document the parts covered by windows that start in a document with a smaller id."""
    first = {}
    for doc_id, sequence in docs:
        for i in range(len(sequence) - size + 1):
            key = parts(sequence[i : i + size])
            first[key] = min(first.get(key, float("inf")), order(doc_id))
    for doc_id, sequence in docs:
        gone = [False] * len(sequence)
        for i in range(len(sequence) - size + 1):
            if first[parts(sequence[i : i + size])] < order(doc_id):
                gone[i : i + size] = [True] * size
        yield doc_id, sequence, gone


def word_repeats(rows, window):
    for doc_id, words, gone in covered([(d, words_of(t)) for d, t in rows], window, tuple):
        yield doc_id, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()


def byte_repeats(rows, length):
    for doc_id, raw, gone in covered([(d, (t or "").encode()) for d, t in rows], length, bytes):
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield doc_id, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)


def fingerprint(text, shingle=3):
    words = WORD.findall(lowered(text))
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_groups(rows, radius=3):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = defaultdict(lambda: float("inf"))
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], order(doc_id))
    for i, (doc_id, _) in enumerate(rows):
        name = least[find(i)]
        yield doc_id, f"{prints[i]:016x}", None if name == float("inf") else name


def contaminations(rows, items, window):
    windows = defaultdict(set)
    for item_id, text in items:
        words = LETTERS_AND_DIGITS.findall(lowered(text))
        for i in [0] if 0 < len(words) < window else range(len(words) - window + 1):
            windows[tuple(words[i : i + window])].add(item_id)
    sizes = set(map(len, windows))
    for doc_id, text in rows:
        words = LETTERS_AND_DIGITS.findall(lowered(text))
        hit, found = [False] * len(words), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if names := windows.get(tuple(words[i : i + size])):
                    found |= names
                    hit[i : i + size] = [True] * size
        yield doc_id, len(words), sum(hit), sorted(str(x) for x in found if x is not None)


def alignments(rows, encode_a, encode_b):
    """Tokens by the libraries on whole texts, groups by walking along the bytes, links by comparing every range."""
    per_doc, counts = [], Counter()
    for doc_id, text in rows:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        raw = (" " + text).encode() if text else b""
        if b"".join(x[1] for x in a) != raw or b"".join(x[1] for x in b) != raw:
            a = b = []
        spans = []
        for side in (a, b):
            at, own = 0, []
            for number, spelt in side:
                own.append((number, at, at + len(spelt)))
                at += len(spelt)
            spans.append(own)
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts):  # noqa: B905
            groups.append("|".join(",".join(str(n) for n, s, e in own if low <= s and e <= high) for own in spans))
        links, j = Counter(), 0
        for number, s, e in spans[0]:
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < e:
                if spans[1][j][2] > s:
                    links[number, spans[1][j][0]] += 1
                j += 1
        counts += links
        per_doc.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for doc_id, n_a, n_b, n_groups, links, groups in per_doc:
        best = sum(n for pair, n in links.items() if counts[pair] == most[pair[1]])
        yield doc_id, n_a, n_b, n_groups, links.total(), best, sum(n * counts[pair] for pair, n in links.items()), groups


def resampled(rows, targets, longest, buckets, least_words, percent, seed):
    def grams(text):
        words = LETTERS_AND_DIGITS.findall(lowered(text))
        return words, [zlib.crc32(b" ".join(words[i : i + n])) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    source, target = ([grams(text) for _, text in table] for table in (rows, targets))
    s, t = (Counter(b for _, own in side for b in own) for side in (source, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    scored = []
    for (doc_id, _), (words, own) in zip(rows, source, strict=True):
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    eligible = sorted((i for i, x in enumerate(scored) if x[4] >= least_words), key=lambda i: (-scored[i][3], order(scored[i][0])))
    ranks = {i: place for place, i in enumerate(eligible[: percent * len(eligible) // 100], 1)}
    for i, x in enumerate(scored):
        yield *x[:4], ranks.get(i)


def secret_spans(text, reach):
    """Base spans as the contract words them; weak ones by comparing every pair of parts."""
    base, weak = [], []
    for kind, pattern in secrets.PATTERNS:
        for m in re.finditer("[0-9a-f]+" if kind == "hex" else pattern, text or "", re.ASCII):
            if kind in secrets.STRONG:
                if len(m[2] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                    base.append((m.start(), kind, m.end()))
            else:
                weak.append((m.start(), kind, m.end()))
    weak = [w for w in weak if not any(b[0] < w[2] and w[0] < b[2] for b in base)]
    parts = [(*x, secrets.PART_OF.get(x[1], x[1])) for x in base + weak]

    def near(x, test):
        return any(y is not x and y[0] - x[2] <= reach and x[0] - y[2] <= reach and test(y) for y in parts)

    def is_part(name):
        return lambda y: y[3] == name

    def known(y):
        return y[3] == "endpoint" and near(y, is_part("identifier"))

    def told(x):
        if x[1] == "secret":
            return near(x, is_part("identifier")) or near(x, known)
        if x[1] == "identifier":
            return near(x, is_part("secret"))
        return x[1] != "endpoint" or near(x, is_part("identifier")) and near(x, is_part("secret"))

    return sorted((x[:3] for x in parts if told(x)), key=lambda x: (x[0], secrets.KINDS.index(x[1]), x[2]))


def key(row):
    return tuple("~" if x is None else f"{x:020d}" if isinstance(x, int) else str(x) for x in row)


def same(one, two):
    return sorted(map(tuple, one), key=key) == sorted(map(tuple, two), key=key)

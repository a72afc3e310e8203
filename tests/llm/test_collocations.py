"""Collocations and their counting filters, next to plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from quayside.llm import collocations
from quayside.llm.collocations import Counted, Packing

DOCS = "doc_id long, lang string, text string"
SMALL = "".maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, least=10, first=2000, inside=50):
    counts, sizes = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        seen = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(SMALL)):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            seen.update(tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        longer = Counter()
        for w, a in candidates.items():
            if len(w) == 3:
                longer[w[:2]] = max(longer[w[:2]], a)
                longer[w[1:]] = max(longer[w[1:]], a)
        rows = []
        for w, a in candidates.items():
            if longer[w] and 100 * longer[w] >= inside * a:
                continue
            cuts = [(1000000 * a * a // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("width", [1, 2, 7, 21, 22, 27, 32])
def test_filters_lose_nothing(width):
    draw = np.random.default_rng(width)
    packing, top = Packing(width), (1 << width) - 1
    triples = draw.integers(0, top, (3, 500), np.uint64, endpoint=True)
    triples = np.concatenate([triples, np.repeat(triples[:, :1], 700, axis=1), np.full((3, 1), top, np.uint64)], axis=1)
    assert all((x == y).all() for x, y in zip(packing.restored(*packing.permuted(*triples)), triples, strict=True))
    parts = [packing.counted(*triples[:, i::3]) for i in range(3)]
    shift = max(packing.quotient - 2, 0)
    total = Counter()
    for first in range(0, 1 << packing.quotient, 1 << shift):
        cut = [Counted(*(x[(p.quotients >= first) & (p.quotients < first + (1 << shift))] for x in p)) for p in parts]
        if packing.quotient <= 22:
            packed = [p.packed(first, first + (1 << shift), packing.remainder) for p in cut]
            cut = [Counted.unpacked(x, 1 << shift, packing.remainder) for x in packed]
        merged = Counted.merged(cut, packing.remainder)
        words = packing.words(merged.quotients, merged.remainders)
        total.update({tuple(map(int, w[:3])): int(w[3]) for w in zip(*words, merged.counts, strict=True)})
    assert total == Counter(tuple(map(int, t)) for t in triples.T)


def test_quotients_spread(spark):
    packing, ids = Packing(12), np.arange(1, 4001, dtype=np.uint64)
    found = packing.counted(ids, ids + np.uint64(1), np.zeros(4000, np.uint64))
    ranges = np.bincount((found.quotients >> np.uint64(packing.quotient - 4)).astype(int), minlength=16)
    assert len(found.counts) == 4000 and ranges.min() > 150 and ranges.max() < 350


def texts(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["The", "the", "É", "é", "a-b", " x", "\x1f", " "]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", "; "]
    return ["".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("chunk_bytes", [8 << 20, 500])
def test_collocations(spark, chunk_bytes):
    docs = [(draw, t) for draw, t in zip(["en", "de", None, "und", ""] * 40, texts(1, 200), strict=True)]
    docs += [("en", "New York City is large. " * 30), ("en", "new york city"), ("en", None), ("fr", ""), ("fr", " ?!"), ("en", "x y z " * 20_000), ("en", "one two\nthree " * 9)]
    table = spark.createDataFrame([(None, *d, "p", 7) for d in docs], DOCS + ", word string, `chunk` int").repartition(4)
    rows = sorted(tuple(r) for r in collocations.collocations(table, chunk_bytes=chunk_bytes).collect())
    assert rows == by_hand(docs)
    found = {(r[0], r[2]): r for r in rows}
    assert ("en", "new york city") in found and ("en", "new york") not in found and ("en", "one two") not in found
    assert {r[0] for r in rows} == {"en", "de", "und"}
    few = sorted(tuple(r) for r in collocations.collocations(table, least=3, first=5, inside=101).collect())
    assert few == by_hand(docs, 3, 5, 101) and {r[0] for r in few} == {"en", "de", "und", ""}


def test_numbers_beyond_64_bits(spark):
    rows = spark.createDataFrame([(30_000_000_000, 50_000_000_000, 30_000_000_001)], "f long, l long, r long")
    assert rows.select(collocations.score("f", "l", "r")).first()[0] == 1000000 * 30_000_000_000**2 // (50_000_000_000 * 30_000_000_001)


def test_no_phrases(spark):
    docs = spark.createDataFrame([(1, "en", "a b c"), (2, None, None), (3, "de", ".")], DOCS).repartition(3)
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs.filter("doc_id = 3")).collect() == []
    assert collocations.collocations(docs.limit(0)).collect() == []

"""Aligned tokenizers, next to both libraries' plain calls on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import alignment
from quayside.llm.alignment import Posting
from quayside.llm.queries import op12_alignment, table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def by_hand(docs):
    """Per row the groups' text and the numbers, token by token."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    back = {v: k for k, v in enumerate_bytes().items()}
    held, rows, best = Counter(), [], {}
    for text in docs:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        a_bytes = [bytes(back[c] for c in one.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [two.id_to_piece(i)]]
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_at, b_at = np.cumsum([0, *map(len, a_bytes)]).tolist(), np.cumsum([0, *map(len, b_bytes)]).tolist()
        links, j = [], 0
        for i in range(len(a)):
            while j < len(b) and b_at[j + 1] <= a_at[i]:
                j += 1
            k = j
            while k < len(b) and b_at[k] < a_at[i + 1]:
                links.append((a[i], b[k]))
                k += 1
        a_place, b_place = {x: i for i, x in enumerate(a_at)}, {x: i for i, x in enumerate(b_at)}
        groups, i, j = [], 0, 0
        for end in sorted(set(a_at[1:]) & set(b_at[1:])):
            m, n = a_place[end], b_place[end]
            groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
            i, j = m, n
        held.update(set(links))
        rows.append((";".join(groups), len(a), len(b), len(groups), links))
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [(g, na, nb, ng, len(ls), sum(held[x] == best[x[0]] for x in ls), sum(held[x] for x in ls)) for g, na, nb, ng, ls in rows]


def enumerate_bytes():
    """byte -> letter, by the definition of byte-level vocabularies."""
    out, n = {}, 0
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174:
            out[x] = chr(x)
        else:
            out[x] = chr(256 + n)
            n += 1
    return out


def row(doc_id, want):
    digest = hashlib.sha256(want[0].encode()).hexdigest() if want[1] else ""
    return (doc_id, digest, *want[1:])


def collected(rows):
    return sorted((r.doc_id, r.groups_sha256, *(r[c] for c in NUMBERS)) for r in rows.collect())


def test_postings_lose_nothing():
    draw = np.random.default_rng(1)
    for n, size in ((1, 1), (3, 9), (60, 61), (1, 1 << 16), (5000, 1 << 16), (1 << 16, 1 << 16)):
        docs = np.sort(draw.choice(size, n, replace=False)).astype(np.int64)
        for links in (np.ones(n, np.int64), draw.integers(1, 300, n), np.full(n, 1 << 40)):
            packed = Posting(docs, links).packed(size)
            assert len(packed[0]) == min(2 * n, -(-size // 8))
            again = Posting.unpacked(*packed, n)
            assert (again.docs == docs).all() and (again.links == links).all()


def test_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = sorted(row(i, w) for (i, _), w in zip(docs, by_hand([t for _, t in docs]), strict=True))
    assert collected(op12_alignment(spark, sf_dir)) == want and sum(r[2] for r in want) > 10_000


def odd_texts():
    draw = random.Random(2)
    parts = ["a", "The", "it's", "don't'll", "naïve", "é", "́x", "▁", "▁x", "日本語", "🙂🙂", "1234567", "...", "?!x", "<s>", "</s>", "<unk>", "<0x41>",
             "<|endoftext|>", "\x00", "\x1c", "\x85", " ", "　b", "﻿", "ﬁ", "\t", "\n", "\r\n", "  ", "   ", "xyzzyqqq" * 9, "Ａ", "_", "#include"]
    blanks = [" ", " ", " ", " ", "  ", "\n", "", " ", "\t "]
    return ["".join(draw.choice(parts) + draw.choice(blanks) for _ in range(draw.randint(0, 12))) for _ in range(400)]


@pytest.mark.parametrize("chunk_bytes", [6 << 20, 300])
def test_odd_texts(spark, chunk_bytes):
    texts = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "x " * 30_000, "a" * 20_000, *odd_texts(), "The a", "The a"]
    docs = spark.createDataFrame([(i // 2, t, "k", 1) for i, t in enumerate(texts)] + [(None, "The", "k", 1)], "doc_id long, text string, pair string, `number` int")
    found = alignment.align(docs.repartition(3), A, B, groups=True, chunk_bytes=chunk_bytes)
    want = by_hand(texts)
    assert collected(found.scored()) == sorted(row(i // 2, w) for i, w in enumerate(want))
    assert sorted(r.groups for r in found.documents.collect()) == sorted(w[0] for w in want)
    assert sum(not w[1] for w in want) >= 4 and sum(w[1] > 0 for w in want) > 200
    totals = found.pair_counts().agg(F.sum("n_links"), F.max("n_docs")).first()
    assert totals[0] == sum(w[4] for w in want)


def test_no_documents(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert collected(alignment.align(docs, A, B).scored()) == [(1, "", 0, 0, 0, 0, 0, 0), (2, "", 0, 0, 0, 0, 0, 0)]
    assert alignment.align(docs.limit(0), A, B).scored().collect() == []

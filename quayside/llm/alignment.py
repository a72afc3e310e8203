"""Two tokenizers aligned: which of their tokens cover the same bytes, and how widely such pairs are known.

Texts are dealt to chunks of bounded size, in which documents have 16-bit numbers. Both
tokenizers work on pieces between single blanks, each different piece once a chunk: no
token of either joins a blank to what stands before it, so the tokens of the pieces in a
row are those of the text. From the pieces a chunk derives an inverted index: per linked
pair of ids the documents that hold it, as a compressed bitmap (sorted numbers or bits,
whichever is shorter), with multiplicity planes: plane k has bit k of the number of links,
for each document of the bitmap. Chunks hold different documents, so OR-merging a pair's
bitmaps lays them side by side and the population count of the union is the sum of the
chunks' counts. Scores of pairs go back to the chunks that hold them, and their postings
add them up per document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import batch, byte_letters, mapped, texts_of
from quayside.session import stage, workspace

#: Bytes of text and documents of a chunk; pieces that are encoded at once.
CHUNK_BYTES, CHUNK_DOCS, ENCODE_PIECES = 6 << 20, 1 << 16, 20_000

_CUT = re.compile(r" (?<=\S )(?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

DOC_ROWS = "chunk long, number int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
PAIR_ROWS = "chunk long, pair long, n_docs int, n_links long, docs binary, planes binary"


class Spans(NamedTuple):
    """Tokens, groups and links of some pieces; ``*_ends`` count them up to each piece's end."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    links: np.ndarray
    n_links: np.ndarray
    texts: list[bytes]


class Aligner:
    """Tokenizer A (byte-level BPE of the tokenizers library) next to B (of sentencepiece, which adds a blank before texts)."""

    def __init__(self, a: str, b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(letters[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(_BYTE.fullmatch(p)[1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        # id and the mark after it: inside and at the end of a group's A ids, then of its B ids
        self.marked = [b"%d%s" % (i, mark) for n, marks in ((len(self.a_bytes), b",|"), (len(self.b_bytes), b",;")) for mark in (marks[:1], marks[1:]) for i in range(n)]
        split = json.loads(self.a.to_str())["pre_tokenizer"] or {}
        #: Texts may be cut before single blanks.
        self.cuts = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not any("▁" in p.lstrip("▁") for p in pieces)

    def pieces(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def align(self, pieces: list[str]) -> Spans:
        """Align ``pieces``, each taken with a blank before it; those that a tokenizer does not give back are not good."""
        a = [x.ids for x in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]
        b = self.b.encode(pieces, num_threads=1)
        good = np.ones(len(pieces), bool)
        for i, p in enumerate(pieces):
            whole = b" " + p.encode()
            good[i] = b"".join(map(self.a_bytes.__getitem__, a[i])) == whole == b"".join(map(self.b_bytes.__getitem__, b[i]))
        a, b = ([x if ok else [] for x, ok in zip(side, good.tolist(), strict=True)] for side in (a, b))
        n_a, n_b = (np.fromiter(map(len, side), np.int64, len(pieces)) for side in (a, b))
        a, b = (np.fromiter((i for x in side for i in x), np.int64, int(n.sum())) for side, n in ((a, n_a), (b, n_b)))
        # good pieces in a row are one run of bytes, and every end of a piece is an end of both
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_last, b_last = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
        first = np.searchsorted(b_ends, a_ends - self.a_sizes[a], "right")
        each = np.searchsorted(b_ends, a_ends, "left") - first + 1
        starts = np.cumsum(each) - each
        links = np.repeat(a << 32, each) | b[np.arange(int(each.sum())) - np.repeat(starts - first, each)]
        return Spans(good, n_a, n_b, self.per_piece(a_last, n_a), links, self.per_piece(each, n_a), self.group_texts(a, b, a_last, b_last, n_a + n_b))

    @staticmethod
    def per_piece(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]

    def group_texts(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Per piece its groups as text, each followed by a semicolon."""
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        codes = np.concatenate([a + n_a * a_last, 2 * n_a + b + n_b * b_last])[order]
        parts = [self.marked[c] for c in codes.tolist()]
        ends = np.cumsum(sizes).tolist()
        return [b"".join(parts[i:j]) for i, j in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=1)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


class Posting(NamedTuple):
    """The documents of one pair in one chunk, and how many links each holds."""

    docs: np.ndarray
    links: np.ndarray

    def packed(self, size: int) -> tuple[bytes, bytes]:
        """A bitmap of ``size`` bits or the sorted numbers, whichever is shorter, and the planes; no planes: one link each."""
        if 2 * len(self.docs) <= -(-size // 8):
            docs = self.docs.astype("<u2").tobytes()
        else:
            bits = np.zeros(size, np.uint8)
            bits[self.docs] = 1
            docs = np.packbits(bits).tobytes()
        most = int(self.links.max())
        planes = [np.packbits((self.links >> k & 1).astype(np.uint8)).tobytes() for k in range(most.bit_length())] if most > 1 else []
        return docs, b"".join(planes)

    @classmethod
    def unpacked(cls, docs: bytes, planes: bytes, n: int) -> Posting:
        numbers = np.frombuffer(docs, "<u2") if len(docs) == 2 * n else np.flatnonzero(np.unpackbits(np.frombuffer(docs, np.uint8)))
        if not planes:
            return cls(numbers.astype(np.int64), np.ones(n, np.int64))
        bits = np.unpackbits(np.frombuffer(planes, np.uint8).reshape(-1, -(-n // 8)), axis=1)[:, :n].astype(np.int64)
        return cls(numbers.astype(np.int64), (bits << np.arange(len(bits))[:, None]).sum(axis=0))


class Chunk:
    def __init__(self):
        self.known: dict[str, int] = {}
        self.docs: list[int] = []
        self.pieces: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int, text: str, tools: Aligner) -> None:
        known = self.known
        pieces = tools.pieces(text) if text else []
        for piece in set(pieces).difference(known):
            known[piece] = len(known)
        self.docs.append(doc_id)
        self.pieces.append(np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces)))
        self.bytes += len(text)

    def rows(self, number: int, tools: Aligner, groups: bool) -> Iterator[pa.RecordBatch]:
        pieces, docs = list(self.known), len(self.docs)
        spans = [tools.align(pieces[i : i + ENCODE_PIECES]) for i in range(0, len(pieces), ENCODE_PIECES)] or [tools.align([])]
        good, n_a, n_b, n_groups, links, n_links = (np.concatenate(x) for x in list(zip(*spans, strict=True))[:6])
        texts = [x for s in spans for x in s.texts]
        bad = np.array([not good[x].all() for x in self.pieces], bool)
        self.pieces = [x[:0] if b else x for x, b in zip(self.pieces, bad, strict=True)]
        runs = [b"".join(map(texts.__getitem__, x.tolist()))[:-1] for x in self.pieces] if groups else []
        digests = [self.digest(texts, x) for x in self.pieces]
        yield batch(
            kind=["docs"] * docs, chunk=np.full(docs, number), number=np.arange(docs, dtype=np.int32), doc_id=np.array(self.docs, np.int64),
            **{name: np.array([int(x[p].sum()) for p in self.pieces], np.int64) for name, x in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links))},
            groups_sha256=pa.array(digests, pa.string()),
            **({"groups": pa.array([x.decode() for x in runs], pa.string())} if groups else {}),
            pair=pa.nulls(docs, pa.int64()), n_docs=pa.nulls(docs, pa.int32()), docs=pa.nulls(docs, pa.binary()), planes=pa.nulls(docs, pa.binary()),
        )
        yield self.postings(number, links, n_links, docs, groups)

    @staticmethod
    def digest(texts: list[bytes], pieces: np.ndarray) -> str:
        whole = hashlib.sha256()
        for i in range(0, len(pieces), 10_000):
            run = b"".join(map(texts.__getitem__, pieces[i : i + 10_000].tolist()))
            whole.update(run if i + 10_000 < len(pieces) else run[:-1])
        return whole.hexdigest() if len(pieces) else ""

    def postings(self, number: int, links: np.ndarray, n_links: np.ndarray, docs: int, groups: bool) -> pa.RecordBatch:
        """A row per pair that this chunk holds, in ascending order."""
        held = np.concatenate([(x << 16) | i for i, x in enumerate(self.pieces)]) if docs else np.zeros(0, np.int64)
        held, times = np.unique(held, return_counts=True)
        each = n_links[held >> 16]
        starts = (np.cumsum(n_links) - n_links)[held >> 16]
        pairs, local = np.unique(links, return_inverse=True)
        at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each - starts, each)
        keys = (local[at] << 16) | np.repeat(held & 0xFFFF, each)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], np.repeat(times, each)[order]
        heads = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(times, heads) if len(heads) else times
        keys = keys[heads]
        bounds = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
        numbers, pairs = keys & 0xFFFF, pairs[keys[bounds] >> 16]
        ends = [*bounds.tolist(), len(keys)]
        packed = [Posting(numbers[i:j], times[i:j]).packed(docs) for i, j in zip(ends, ends[1:], strict=False)]
        n = len(packed)
        empty = {name: pa.nulls(n, pa.int64()) for name in ("doc_id", "n_a", "n_b", "n_groups")}
        return batch(
            kind=pa.array(["pairs"] * n, pa.string()), chunk=np.full(n, number), number=pa.nulls(n, pa.int32()), **empty,
            n_links=np.add.reduceat(times, bounds).astype(np.int64) if n else pa.nulls(0, pa.int64()), groups_sha256=pa.nulls(n, pa.string()),
            **({"groups": pa.nulls(n, pa.string())} if groups else {}),
            pair=pairs, n_docs=np.diff(ends).astype(np.int32) if n else pa.nulls(0, pa.int32()),
            docs=pa.array([x for x, _ in packed], pa.binary()), planes=pa.array([x for _, x in packed], pa.binary()),
        )


def align_chunks(a: str, b: str, chunk_bytes: int, groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, number, chunk = aligner(a, b), TaskContext.get().partitionId() << 32, Chunk()
        for rows in batches:
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text"), strict=True):
                chunk.add(doc_id, text.as_py(), tools)
                if chunk.bytes >= chunk_bytes or len(chunk.docs) == CHUNK_DOCS:
                    yield from chunk.rows(number, tools, groups)
                    chunk, number = Chunk(), number + 1
        if chunk.docs:
            yield from chunk.rows(number, tools, groups)

    return run


def add_up(key: tuple, postings: pa.Table, scores: pa.Table) -> pa.Table:
    """What the pairs of one chunk score, per document."""
    pairs = postings.column("pair").to_numpy()
    order = np.argsort(pairs)
    found = scores.column("of").to_numpy()
    place = order[np.searchsorted(pairs[order], found)]
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    count[place], best[place] = scores.column("count").to_numpy(), scores.column("best").to_numpy()
    kept = [Posting.unpacked(*x) for x in zip(*(postings.column(c).to_pylist() for c in ("docs", "planes", "n_docs")), strict=True)]
    docs, links = np.concatenate([x.docs for x in kept]), np.concatenate([x.links for x in kept])
    of = np.repeat(np.arange(len(kept)), [len(x.docs) for x in kept])
    n_best, count_sum = np.zeros((2, int(docs.max()) + 1), np.int64)
    np.add.at(n_best, docs, links * best[of])
    np.add.at(count_sum, docs, links * count[of])
    numbers = np.unique(docs)
    return pa.table({
        "chunk": np.full(len(numbers), postings.column("chunk")[0].as_py()), "number": numbers.astype(np.int32),
        "n_best": n_best[numbers], "count_sum": count_sum[numbers],
    })


class Alignment(NamedTuple):
    """Documents and the inverted index of their pairs, as written to the shared folder."""

    documents: DataFrame
    postings: DataFrame

    def pair_counts(self) -> DataFrame:
        """``pair, n_docs, n_links``: documents that hold a pair of ids (the A id above bit 32), and its links."""
        return self.postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))

    def scored(self) -> DataFrame:
        """The documents with ``n_best`` and ``count_sum``."""
        counts = stage(self.pair_counts().select("pair", F.col("n_docs").alias("count"), F.shiftright("pair", 32).alias("a")), "pair-counts")
        highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
        best = (F.col("count") == F.col("highest")).cast("long").alias("best")
        scores = counts.join(highest, "a").select("pair", "count", best)
        returned = self.postings.select(F.col("chunk").alias("to"), "pair").join(scores, "pair").select("to", F.col("pair").alias("of"), "count", "best")
        sums = (
            self.postings.select("chunk", "pair", "n_docs", "docs", "planes")
            .groupBy("chunk")
            .cogroup(returned.groupBy("to"))
            .applyInArrow(add_up, "chunk long, number int, n_best long, count_sum long")
        )
        return self.documents.join(sums, ["chunk", "number"], "left").fillna(0, ["n_best", "count_sum"]).drop("chunk", "number")


def align(docs: DataFrame, a: str, b: str, groups: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Alignment:
    """Align the tokens of a blank and every whole text by tokenizer files ``a`` and ``b``, which all executors can open.

    Documents: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and, if asked for, the
    groups themselves. Null and empty texts, and texts that one of the tokenizers does not
    give back byte by byte, have no tokens: zeros and empty text. Rows without doc_id are left
    out; rows that repeat a doc_id are documents each; other columns are dropped. An empty
    table gives none.
    """
    more = ", groups string" if groups else ""
    schema = f"kind string, {DOC_ROWS}{more}, pair long, n_docs int, docs binary, planes binary"
    path = workspace(docs.sparkSession, "alignment")
    mapped(texts_of(docs), align_chunks(a, b, chunk_bytes, groups), schema).write.partitionBy("kind").parquet(path)
    rows = docs.sparkSession.read.schema(schema).parquet(path)
    names = [x.split()[0] for x in f"{DOC_ROWS}{more}".split(", ")]
    postings = [x.split()[0] for x in PAIR_ROWS.split(", ")]
    return Alignment(rows.filter("kind = 'docs'").select(*names), rows.filter("kind = 'pairs'").select(*postings))

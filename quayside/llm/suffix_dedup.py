"""Removal of repeated byte strings, decided on Burrows-Wheeler transforms.

Every string of ``LENGTH`` bytes that also starts earlier (in a smaller doc_id, or
before in the same document) is a repeat; bytes that repeats cover are removed.

1. *Anchors.* In each window of ``LENGTH`` bytes the 32-byte gram of least hash
   (leftmost among equals) is its anchor. Equal windows have equal anchors, so only
   places whose anchor occurs twice can hold repeats; about one byte in 35 is an
   anchor and only those are shuffled. An anchor's context is the stretch that all
   its windows cover.
2. *Copies.* Equal contexts collapse to their first place before anything is compared;
   all windows of the others are repeats. So a group of copies of any size sends one
   row per map task and context.
3. *Transform.* Contexts that share an anchor and differ meet in a bucket of bounded
   size. There the suffixes are sorted, and a breadth-first backward extension over
   intervals of the transform yields the common prefixes of neighbours by increasing
   value. It stops at ``LENGTH``: boundaries not found until then lie inside classes of
   equal windows, of which all but the first are repeats.
4. Contexts of an anchor with very many of them (a short, common line) are cut in halves
   by the places of their windows. A half's windows share more bytes than the anchor, which
   part the group; equal halves collapse again, and what is still large is cut once more,
   at last into single windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import batch, by_rows, mapped, text_bytes, texts_of
from quayside.session import stage

LENGTH = 100
GRAM = 32
#: Window starts handled at once, few enough that their hashes stay in the processor's cache.
#: The anchor order uses 40 hash bits beside 24 bits of place.
STRIDE = 1 << 15
#: Groups of more different contexts than this are cut.
HOT_CONTEXTS = 1000
#: Bytes of context that one bucket's transform holds on average; larger ones leave the cache.
BUCKET_BYTES = 1 << 18
PIECE = ("key", "doc_id", "start", "piece", "shift", "low", "high")
PIECES = "key long, doc_id long, start int, piece binary, shift int, low int, high int"

_PLACE = np.uint64((1 << 24) - 1)
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each 32-byte gram, by doubling."""
    h, width = _BYTE[data], 1
    for odd in _ODD:
        h = h[:-width] * odd + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    return h * _ODD[0]


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows that lie within a document, and their hashes."""
    at, hashes = [], []
    last = len(data) - LENGTH + 1
    for low in range(0, max(last, 0), STRIDE):
        piece = data[low : min(low + STRIDE + LENGTH - 1, len(data))]
        h = gram_hashes(piece)
        least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        width, grams = 1, LENGTH - GRAM + 1
        while 2 * width <= grams:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (grams - width)], least[grams - width :])
        within = np.ones(len(least), bool)
        i, j = np.searchsorted(bounds, (low, low + len(least) + LENGTH))
        for end in (bounds[i:j] - low).tolist():
            within[max(end - LENGTH + 1, 0) : max(end, 0)] = False
        own = (least[within] & _PLACE).astype(np.int64)
        own = own[np.flatnonzero(np.diff(own, prepend=-1))]
        at.append(own + low)
        hashes.append(h[own])
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(at), return_index=True)
    return at, np.concatenate(hashes)[first]


def joined_texts(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    view, bounds = text_bytes(column)
    low = int(bounds[0])
    return view[low : int(bounds[-1])], bounds - low


def find_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors' hashes alone, to count them."""
    for rows in batches:
        buffer, bounds = joined_texts(rows.column("text"))
        yield batch(key=anchors(np.frombuffer(buffer, np.uint8), bounds)[1].view(np.int64))


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        buffer, bounds = joined_texts(rows.column("text"))
        at, keys = anchors(np.frombuffer(buffer, np.uint8), bounds)
        doc = np.searchsorted(bounds, at, side="right") - 1
        left = np.maximum(at - (LENGTH - GRAM), bounds[doc])
        right = np.minimum(at + LENGTH, bounds[doc + 1])
        digest = xxhash.xxh3_64_intdigest
        contexts = [digest(buffer[i:j]) for i, j in zip(left.tolist(), right.tolist(), strict=True)]
        ids = rows.column("doc_id").to_numpy(zero_copy_only=False)
        yield batch(
            key=keys.view(np.int64),
            context=np.array(contexts, np.uint64).view(np.int64),
            doc_id=ids[doc].astype(np.int64),
            pos=(at - bounds[doc]).astype(np.int32),
        )


def read_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts; ``shift`` is the first window's place, seen from the anchor."""
    for rows in batches:
        out: list[tuple] = []
        for doc_id, text, wanted in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "wanted")), strict=True):
            data = text.encode()
            for place in wanted:
                pos = place["pos"]
                left = max(pos - (LENGTH - GRAM), 0)
                out.append((place["key"], doc_id, left, data[left : pos + LENGTH], left - pos, GRAM - LENGTH, 0))
        yield piece_batch(out)


def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces cut in two by the places of their windows, seen from the anchor.

    All windows of a half share the bytes from its last start to its first end; these and
    the key so far make its key, so equal windows stay together.
    """
    for rows in batches:
        out: list[tuple] = []
        for key, doc_id, start, piece, shift, low, high in zip(*(rows.column(c).to_pylist() for c in PIECE), strict=True):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle + 1, high)):
                first, last = max(shift, a), min(shift + len(piece) - LENGTH, b)
                if first <= last:
                    common = piece[b - shift : a - shift + LENGTH]
                    own = xxhash.xxh3_64_digest(key.to_bytes(8, "little", signed=True) + common, b - GRAM + LENGTH)
                    part = piece[first - shift : last - shift + LENGTH]
                    out.append((int.from_bytes(own, "little", signed=True), doc_id, start + first - shift, part, first, a, b))
        yield piece_batch(out)


def piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(PIECE)
    types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
    return batch(**{c: pa.array(v, t) for c, v, t in zip(PIECE, columns, types, strict=True)})


def sorted_suffixes(data: np.ndarray) -> np.ndarray:
    """Suffixes in the order of their first 128 symbols, by prefix doubling from 8."""
    n = len(data)

    def later(x: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([x[by:], np.zeros(min(by, n), x.dtype)])

    key = data.astype(np.uint64)
    for width in (1, 2, 4):
        key = (key << np.uint64(8 * width)) | later(key, width)
    width = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]])).astype(np.uint64)
        if width >= LENGTH:
            return order
        key = (rank << np.uint64(32)) | later(rank, width)
        width *= 2


def class_bounds(bwt: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix shares fewer than ``length`` symbols with the one before it.

    ``bwt`` holds the symbol before each suffix in sorted order, 0 being the end mark.
    An interval holds the suffixes that begin with some string; extending the string by
    one symbol to the left gives the next ones. An interval's upper end that no shorter
    string has shown lies between suffixes which share exactly that string's rest.
    Intervals that show nothing new are dropped, so each end is found once.
    """
    n = len(bwt)
    places = np.argsort(bwt, kind="stable")
    rank = np.empty(n, np.int64)
    rank[places] = np.arange(n)
    symbol = bwt.astype(np.int64)
    listed = symbol[places] * (n + 1) + places  # all places of the first symbol, then the next
    following = np.full(n, n, np.int64)
    same = np.flatnonzero(symbol[places[1:]] == symbol[places[:-1]])
    following[places[same]] = places[same + 1]
    present = np.unique(symbol)
    found = np.zeros(n + 1, bool)
    found[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for depth in range(length):
        wide = high - low > 4 * len(present)
        new_low, new_high = [], []
        if wide.any():  # all symbols at once: their ends lie apart; fewer than n / 4 of them
            each = (present[present > 0] if depth else present)[:, None] * (n + 1)
            i, j = (np.searchsorted(listed, (each + x[wide]).ravel()) for x in (low, high))
            new = (i < j) & ~found[j]
            found[j[new]] = True
            new_low.append(i[new])
            new_high.append(j[new])
        i, j = low[~wide], high[~wide]
        size = j - i
        of = np.repeat(np.arange(len(i)), size)
        q = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + i[of]
        last = following[q] >= j[of]
        if depth:
            last &= symbol[q] != 0
        q, of = q[last], of[last]
        end = rank[q] + 1
        new = ~found[end]
        q, of, end = q[new], of[new], end[new]
        found[end] = True
        new_low.append(np.searchsorted(listed, symbol[q] * (n + 1) + i[of]))
        new_high.append(end)
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        if not len(low):
            break
    return found[:n]


def repeats_in(doc: np.ndarray, start: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first and last byte + 1 of the stretches that repeated windows cover.

    Pieces are contexts at (doc, start); the same place may lie in several pieces.
    """
    sizes = np.array([len(p) for p in pieces])
    ids, number = np.unique(doc, return_inverse=True)
    data = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # no UTF-8 byte is 255
    base = np.cumsum(sizes + 1) - sizes - 1
    of = np.repeat(np.arange(len(pieces)), sizes + 1)
    inside = np.arange(len(data)) - base[of]
    place = (number[of].astype(np.int64) << 32) + start[of] + inside
    whole = sizes[of] - inside >= LENGTH
    order = sorted_suffixes(data)
    classes = np.cumsum(class_bounds(data[order - 1], LENGTH))
    whole, place = whole[order], place[order]
    classes, place = classes[whole], place[whole]
    if not len(classes):
        return ids[:0], place[:0], place[:0]
    heads = np.flatnonzero(np.diff(classes, prepend=-1))
    first = np.repeat(np.minimum.reduceat(place, heads), np.diff(heads, append=len(classes)))
    repeated = np.unique(place[place > first])
    cut = np.flatnonzero(np.diff(repeated) > LENGTH) + 1
    begin = repeated[np.concatenate([[0], cut])] if len(repeated) else repeated
    end = repeated[np.concatenate([cut - 1, [len(repeated) - 1]])] if len(repeated) else repeated
    return ids[begin >> 32], begin & 0xFFFFFFFF, (end & 0xFFFFFFFF) + LENGTH


def compare_bucket(rows: pa.Table) -> pa.Table:
    doc = rows.column("doc_id").to_numpy()
    start = rows.column("start").to_numpy().astype(np.int64)
    ids, begin, end = repeats_in(doc, start, rows.column("piece").to_pylist())
    return pa.Table.from_batches([batch(doc_id=ids.astype(np.int64), start=begin.astype(np.int32), stop=end.astype(np.int32))])


def merged(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones as one, within ``size`` bytes."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        start, stop = max(start, 0), min(stop, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        elif start < stop:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        view, bounds = text_bytes(rows.column("text"))
        found, kept = [], []
        for i, spans in enumerate(rows.column("spans").to_pylist()):
            data = view[int(bounds[i]) : int(bounds[i + 1])]
            runs = merged([(s["start"], s["stop"]) for s in spans or ()], len(data))
            edges = [0, *(x for run in runs for x in run), len(data)]
            found.append([{"start": a, "stop": b} for a, b in runs])
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        size = np.diff(bounds)
        yield batch(doc_id=rows.column("doc_id"), n_bytes=size, spans=pa.array(found, span), kept=pa.array(kept, pa.binary()))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, start, stop``: stretches covered by repeats, still overlapping each other."""
    texts = texts_of(docs)
    places = mapped(texts, find_anchors, "key long, context long, doc_id long, pos int")
    keys = mapped(texts, find_keys, "key long")
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    seen = stage(places.join(twice, "key", "left_semi"), "anchors")
    firsts = stage(
        seen.groupBy("key", "context").agg(F.min(F.struct("doc_id", "pos")).alias("first")),
        "contexts",
    )
    copies = (
        seen.join(firsts, ["key", "context"])
        .filter((F.col("doc_id") != F.col("first.doc_id")) | (F.col("pos") != F.col("first.pos")))
        .select("doc_id", (F.col("pos") - (LENGTH - GRAM)).alias("start"), (F.col("pos") + LENGTH).alias("stop"))
    )
    mixed = firsts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    wanted = (
        firsts.join(mixed, "key")
        .groupBy(F.col("first.doc_id").alias("doc_id"))
        .agg(F.collect_list(F.struct("key", F.col("first.pos").alias("pos"))).alias("wanted"))
    )
    pieces = stage(mapped(texts.join(wanted, "doc_id"), read_contexts, PIECES), "pieces")
    found = copies
    while True:
        counts = pieces.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        counted = pieces.join(counts, "key")
        hot = (F.col("n") > HOT_CONTEXTS) & (F.col("low") < F.col("high"))
        found = found.union(compared(counted.filter(~hot)))
        halves = stage(mapped(counted.filter(hot).select(*PIECE), halve, PIECES), "halves")
        if halves.isEmpty():
            return found
        place = [c for c in PIECE if c not in ("key", "piece")]
        firsts = stage(halves.groupBy("key", "piece").agg(F.min(F.struct(*place)).alias("first")), "halves-once")
        found = found.union(
            halves.join(firsts, ["key", "piece"])
            .filter((F.col("doc_id") != F.col("first.doc_id")) | (F.col("start") != F.col("first.start")))
            .select("doc_id", "start", (F.col("start") + F.length("piece")).alias("stop"))
        )
        pieces = firsts.select("key", "piece", "first.*").select(*PIECE)


def compared(pieces: DataFrame) -> DataFrame:
    """Repeats among pieces of equal key, found in buckets of whole keys."""
    total = pieces.agg(F.sum(F.length("piece"))).first()[0] or 0
    buckets = by_rows(pieces.sparkSession, total, BUCKET_BYTES)
    dealt = pieces.select("doc_id", "start", "piece", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").applyInArrow(compare_bucket, "doc_id long, start int, stop int")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: documents without the bytes that repeats cover.

    ``spans`` are the removed stretches (start, stop) in order; ``kept`` are the other
    bytes, which need not be valid UTF-8 as a string may begin inside a character.
    Null and empty texts, and texts under ``LENGTH`` bytes, stay as they are. Rows
    without doc_id are left out. doc_id tells rows apart: rows that share one count as
    one place, are not repeats of each other, and share their spans.
    """
    spans = repeated_spans(docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = texts_of(docs).join(spans, "doc_id", "left")
    return mapped(joined, remove_spans, "doc_id long, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")

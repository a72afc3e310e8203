"""Phrases whose words keep company, counted in counting quotient filters.

Texts are encoded once, in chunks of bounded size with dictionaries of their own. Words
too rare to stand in any phrase go; the others get dense numbers, corpus-wide. A phrase of
two or three words, packed as three numbers of equal width (0 for a missing third), is put
through an invertible permutation. Its high bits are the quotient, all others the
remainder: nothing is lost, and quotients spread evenly however often a phrase occurs. Each
chunk counts its phrases in a sorted filter, which says in unary how many remainders each
quotient has, and keeps the remainders in full and counters of one byte that escape to eight.
Filters are cut by ranges of quotients, and those of one range are merged across all chunks.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import batch, mapped, prepare, sent_if_small, text_bytes
from quayside.session import stage, workspace

#: Occurrences of a phrase, phrases returned of each language, and the percentage of a phrase's
#: occurrences inside one longer phrase from which it is dropped.
LEAST, FIRST, INSIDE = 10, 2000, 50
#: Bytes of text of a chunk, and phrases of a range of quotients on average.
CHUNK_BYTES, RANGE_PHRASES = 5 << 20, 2_000_000
#: Bits of a quotient: about one phrase of a chunk to each.
QUOTIENT = 21
#: Groups that a language is ranked in before its best meet.
RANK_GROUPS = 64

_MARK = b"\xff"  # in no UTF-8 text
_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t" + _ENDS, bytes(range(97, 123)) + b" " + _MARK * len(_ENDS))


class Words(dict):
    """Numbers of one language's words; a new one gets the next number of its chunk."""

    def __init__(self, chunk: Chunk):
        super().__init__({_MARK: 0})
        self.chunk = chunk

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.chunk.known
        self.chunk.known += 1
        return number


class Chunk:
    """Words of some texts as numbers of its own, 0 between pieces."""

    def __init__(self):
        self.words: dict[str, Words] = {}
        self.ids: list[np.ndarray] = []
        self.size, self.known = 0, 1

    def add(self, lang: str, folded: bytes) -> None:
        words = folded.replace(_MARK, b" " + _MARK + b" ").split()
        known = self.words.get(lang)
        if known is None:
            known = self.words[lang] = Words(self)
        self.ids += [np.fromiter(map(known.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        self.size += len(folded)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """The dictionary, a word a row, and the texts as one row; common words have small numbers."""
        ids = np.concatenate(self.ids)
        counts = np.bincount(ids, minlength=self.known)
        counts[0] = len(ids) + 1
        place = np.empty(self.known, np.uint32)
        place[np.argsort(-counts, kind="stable")] = np.arange(self.known, dtype=np.uint32)
        langs, words, local = [], [], []
        for lang, known in self.words.items():
            langs += [lang] * (len(known) - 1)
            words += list(known)[1:]
            local += list(known.values())[1:]
        none, at = len(words), np.array(local, np.int64)
        yield batch(
            kind=pa.array(["words"] * none, pa.string()), chunk=np.full(none, number), lang=pa.array(langs, pa.string()), word=pa.array(words, pa.binary()),
            local=place[at].astype(np.int32), n=counts[at], ids=pa.nulls(none, pa.binary()),
        )
        packed = pa.compress(place[ids].tobytes(), "zstd", asbytes=True)
        sizes = struct.pack("<Q", len(ids)) + packed
        yield batch(
            kind=["ids"], chunk=np.array([number]), lang=pa.nulls(1, pa.string()), word=pa.nulls(1, pa.binary()),
            local=pa.nulls(1, pa.int32()), n=pa.nulls(1, pa.int64()), ids=pa.array([sizes], pa.binary()),
        )


def encode_chunks(chunk_bytes: int):
    """Texts as chunks; a longer text is cut between two pieces, as no phrase lies across them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        chunk = Chunk()
        for rows in batches:
            view, bounds = text_bytes(rows.column("text"))
            for lang, i, j in zip(rows.column("lang").to_pylist(), bounds.tolist(), bounds[1:].tolist(), strict=False):
                while i < j:
                    end = _END.search(view, i + chunk_bytes, j)
                    k = end.end() if end else j
                    chunk.add(lang, bytes(view[i:k]).translate(_FOLD))
                    i = k
                    if chunk.size >= chunk_bytes:
                        yield from chunk.rows(number)
                        chunk, number = Chunk(), number + 1
        if chunk.ids:
            yield from chunk.rows(number)

    return run


class Packing(NamedTuple):
    """Three word numbers of ``width`` bits as a quotient and a remainder of 64 bits at most."""

    width: int

    @property
    def quotient(self) -> int:
        return min(max(QUOTIENT, 3 * self.width - 64), 3 * self.width)

    @property
    def remainder(self) -> int:
        return 3 * self.width - self.quotient

    def _mixed(self, x: np.ndarray, y: np.ndarray, turn: int) -> np.ndarray:
        h = x * np.uint64(0x9E3779B97F4A7C15) + y * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(turn * 0x165667B19E3779F9 % 2**64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(24)) & np.uint64((1 << self.width) - 1)

    def permuted(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Six turns, each of which adds a mixture of two numbers to the third and can be undone."""
        for turn in range(6):
            a, b, c = b, c, a ^ self._mixed(b, c, turn)
        return a, b, c

    def restored(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for turn in reversed(range(6)):
            a, b, c = c ^ self._mixed(a, b, turn), a, b
        return a, b, c

    def counted(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> Counted:
        """Each different triple once, sorted, with its number of times."""
        a, b, c = self.permuted(a, b, c)
        w, r = np.uint64(self.width), np.uint64(self.remainder)
        low = (b << w) | c
        if 3 * self.width <= 64:
            keys = np.sort((a << (w + w)) | low)
            heads = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            quotients, remainders = keys[heads] >> r, keys[heads] & np.uint64((1 << self.remainder) - 1)
        else:
            rest = np.uint64(self.width - self.quotient)
            quotients, remainders = a >> rest, ((a & ((np.uint64(1) << rest) - np.uint64(1))) << (w + w)) | low
            order = np.lexsort((remainders, quotients))
            quotients, remainders = quotients[order], remainders[order]
            heads = Counted.heads(quotients, remainders)
            quotients, remainders = quotients[heads], remainders[heads]
        return Counted(quotients, remainders, np.diff(heads, append=len(a)))

    def words(self, quotients: np.ndarray, remainders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The word numbers again."""
        w, mask = np.uint64(self.width), np.uint64((1 << self.width) - 1)
        if 3 * self.width <= 64:
            keys = (quotients << np.uint64(self.remainder)) | remainders
            return self.restored(keys >> (w + w), (keys >> w) & mask, keys & mask)
        rest = np.uint64(self.width - self.quotient)
        return self.restored((quotients << rest) | (remainders >> (w + w) if rest else np.uint64(0)), (remainders >> w) & mask, remainders & mask)


class Counted(NamedTuple):
    """Sorted, different pairs of quotient and remainder, with counts."""

    quotients: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @staticmethod
    def heads(quotients: np.ndarray, remainders: np.ndarray) -> np.ndarray:
        fresh = np.ones(len(quotients), bool)
        fresh[1:] = (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1])
        return np.flatnonzero(fresh)

    @classmethod
    def merged(cls, filters: list[Counted], bits: int) -> Counted:
        """The sum of sorted filters with remainders of ``bits`` bits: a stable sort finds their runs and merges them."""
        quotients, remainders, counts = (np.concatenate(x) for x in zip(*filters, strict=True))
        if int(quotients.max(initial=0)).bit_length() + bits <= 64:
            order = np.argsort((quotients << np.uint64(bits)) | remainders, kind="stable")
        else:
            order = np.lexsort((remainders, quotients))
        quotients, remainders, counts = quotients[order], remainders[order], counts[order]
        heads = cls.heads(quotients, remainders)
        return cls(quotients[heads], remainders[heads], np.add.reduceat(counts, heads) if len(heads) else counts)

    def packed(self, first: int, stop: int, bits: int) -> bytes:
        """As bytes: quotients from ``first`` to before ``stop`` in unary, remainders of ``bits`` bits, counters."""
        n = len(self.counts)
        unary = np.zeros(n + stop - first, np.uint8)
        unary[(self.quotients.astype(np.int64) - first) + np.arange(n)] = 1
        low = self.remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-bits // 8)]
        large = self.counts[self.counts >= 255].astype("<i8")
        small = np.minimum(self.counts, 255).astype(np.uint8)
        return struct.pack("<QQ", n, first) + np.packbits(unary).tobytes() + low.tobytes() + small.tobytes() + large.tobytes()

    @classmethod
    def unpacked(cls, data: bytes, width: int, bits: int) -> Counted:
        """``width``: of the range of quotients."""
        n, first = struct.unpack_from("<QQ", data)
        at, end, each = 16, 16 + (n + width + 7) // 8, -(-bits // 8)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, end - at, at)))
        low = np.zeros((n, 8), np.uint8)
        low[:, :each] = np.frombuffer(data, np.uint8, n * each, end).reshape(n, each)
        counts = np.frombuffer(data, np.uint8, n, end + n * each).astype(np.int64)
        counts[counts == 255] = np.frombuffer(data, "<i8", -1, end + n * each + n)
        return cls((ones - np.arange(n) + first).astype(np.uint64), low.view("<u8").ravel().astype(np.uint64), counts)


def count_chunk(packing: Packing, ranges: int):
    """Filters of a chunk's phrases, cut into 2**ranges ranges of quotients."""
    schema = pa.schema([("range", pa.int64()), ("filter", pa.binary())])

    def run(key: tuple, texts: pa.Table, numbers: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        if len(texts) and len(numbers):
            data = texts.column("ids")[0].as_py()
            (n,) = struct.unpack_from("<Q", data)
            local = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), np.uint32)
            known = np.zeros(int(local.max()) + 1, np.uint64)
            known[numbers.column("local").to_numpy()] = numbers.column("id").to_numpy().astype(np.uint64)
            ids = known[local]
            two = (ids[:-1] > 0) & (ids[1:] > 0)
            three = np.flatnonzero(two[:-1] & two[1:])
            two = np.flatnonzero(two)
            if len(two):
                a, b = np.concatenate([ids[two], ids[three]]), np.concatenate([ids[two + 1], ids[three + 1]])
                found = packing.counted(a, b, np.concatenate([np.zeros(len(two), np.uint64), ids[three + 2]]))
                shift = packing.quotient - ranges
                bounds = np.searchsorted(found.quotients >> np.uint64(shift), np.arange((1 << ranges) + 1, dtype=np.uint64))
                for number, (i, j) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)):
                    if j > i:
                        part = Counted(*(x[i:j] for x in found))
                        packed = part.packed(number << shift, (number + 1) << shift, packing.remainder)
                        out.append(batch(range=np.array([number]), filter=pa.array([packed], pa.binary())))
        return pa.Table.from_batches(out, schema)

    return run


def merge_range(packing: Packing, ranges: int, least: int):
    def run(key: tuple, filters: pa.Table) -> pa.Table:
        width = 1 << (packing.quotient - ranges)
        found = Counted.merged([Counted.unpacked(x, width, packing.remainder) for x in filters.column("filter").to_pylist()], packing.remainder)
        often = found.counts >= least
        a, b, c = (x.astype(np.int64) for x in packing.words(found.quotients[often], found.remainders[often]))
        return pa.table({"a": a, "b": b, "c": c, "f": found.counts[often].astype(np.int64)})

    return run


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of word and language, with the number of their word in this partition, from 0 on."""
    part, number, last = TaskContext.get().partitionId(), -1, None
    for rows in batches:
        if not len(rows):
            continue
        words, langs = rows.column("word"), rows.column("lang")
        fresh = np.ones(len(rows), bool)
        fresh[0] = last != (words[0].as_py(), langs[0].as_py())
        for column in (words, langs):
            differ = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            fresh[1:] = differ if column is words else fresh[1:] | differ
        numbers = number + np.cumsum(fresh)
        number, last = int(numbers[-1]), (words[-1].as_py(), langs[-1].as_py())
        none = pa.array(~fresh)  # language, word and count stand in a word's first row alone
        yield batch(
            chunk=rows.column("chunk"), local=rows.column("local"), part=np.full(len(rows), part, np.int32), place=numbers,
            lang=pc.if_else(none, None, langs), word=pc.if_else(none, pa.scalar(None, pa.binary()), words), f=pc.if_else(none, None, rows.column("f")),
        )


def phrase_counts(docs: DataFrame, least: int, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases ``a, b, c, f`` (word numbers, c = 0 for two words) with f >= least; words ``id, lang, word, f``; ``lang, n``."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "kind string, chunk long, lang string, word binary, local int, n long, ids binary"
    path = workspace(spark, "chunks")
    mapped(texts, encode_chunks(chunk_bytes), schema).write.partitionBy("kind").parquet(path)
    chunks = spark.read.schema(schema).parquet(path)
    words = chunks.filter("kind = 'words'").select("lang", "word", "chunk", "local", "n")
    # a word has a row per chunk at most, and its rows lie together: they are numbered as they come
    frequent = words.withColumn("f", F.sum("n").over(Window.partitionBy("word", "lang"))).filter(F.col("f") >= least)
    places = "chunk long, local int, part int, place long, lang string, word binary, f long"
    placed = stage(mapped(frequent.select("lang", "word", "f", "chunk", "local"), numbered, places), "frequent-words")
    size, total, bases = 0, 0, []
    for part, n, own in placed.groupBy("part").agg(F.max("place") + 1, F.sum("f")).orderBy("part").collect():  # a row per partition
        bases.append((part, size))
        size, total = size + n, total + own
    base = F.broadcast(spark.createDataFrame(bases, "part int, base long"))
    numbers = placed.join(base, "part").withColumn("id", F.col("base") + F.col("place") + 1)
    vocabulary = numbers.filter("word IS NOT NULL").select("id", "lang", "word", "f")
    packing = Packing(max(size.bit_length(), 1))
    if packing.width > 32:
        raise ValueError("more than 2**32 frequent words")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length() + 2
    ranges = min(max(spread, (2 * total // RANGE_PHRASES).bit_length()), packing.quotient)
    numbers = numbers.select("chunk", "local", "id")
    ids = chunks.filter("kind = 'ids'").select("chunk", "ids")
    filters = ids.groupBy("chunk").cogroup(numbers.groupBy("chunk")).applyInArrow(count_chunk(packing, ranges), "range long, filter binary")
    phrases = filters.groupBy("range").applyInArrow(merge_range(packing, ranges, least), "a long, b long, c long, f long")
    return stage(phrases, "phrases"), vocabulary, words.groupBy("lang").agg(F.sum("n").alias("n"))


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 37 digits."""
    one, two, three = (f"CAST({x} AS DECIMAL(14, 0))" for x in (a, left, right))
    return F.expr(f"({one} * {one} * 1000000) div ({two} * {three})")


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, inside: int = INSIDE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of 2 or 3 words that hold together best, per language.

    ``docs``: lang (null: und) and text (null: empty); every row counts, repeated ones as
    often as they stand there, and other columns are dropped. a, l and r are occurrences of
    the phrase and of its parts at the cut that scores lowest (ties: the first), n all words
    of the language. Phrases that lie inside a longer one in ``inside`` of 100 occurrences or
    more are left out. Ties of a score go to the larger a, then to the phrase in byte order.
    An empty table, or one without repeated phrases, gives no rows.
    """
    phrases, words, sizes = phrase_counts(docs, least, chunk_bytes)

    def word(at: str, *more: str) -> DataFrame:
        return words.select(F.col("id").alias(at), F.col("word").cast("string").alias(f"word_{at}"), F.col("f").alias(f"f_{at}"), *more)

    two, three = phrases.filter("c = 0").drop("c"), phrases.filter("c > 0")
    longer = three.select("a", "b", "f").union(three.select("b", "c", "f")).groupBy("a", "b").agg(F.max("f").alias("longest"))
    alone = two.join(longer, ["a", "b"], "left").filter(F.coalesce(100 * F.col("longest") < inside * F.col("f"), F.lit(True)))
    firsts = two.withColumnRenamed("f", "f_ab")
    lasts = two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc"))
    whole = three.join(firsts, ["a", "b"]).join(lasts, ["b", "c"])
    every = whole.unionByName(alone.drop("longest"), allowMissingColumns=True)
    found = every.join(word("a", "lang"), "a").join(word("b"), "b").join(word("c"), "c", "left")
    only = F.col("c").isNull()
    found = found.withColumn("one", F.when(only, score("f", "f_a", "f_b")).otherwise(score("f", "f_a", "f_bc")))
    found = found.withColumn("two", F.when(~only, score("f", "f_ab", "f_c")))
    later = F.coalesce(F.col("two") < F.col("one"), F.lit(False))
    scored = found.select(
        "lang",
        F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"),
        F.col("f").alias("a"),
        F.when(later, F.col("f_ab")).otherwise(F.col("f_a")).alias("l"),
        F.when(later, F.col("f_c")).when(only, F.col("f_b")).otherwise(F.col("f_bc")).alias("r"),
        F.when(later, F.col("two")).otherwise(F.col("one")).alias("score"),
    )
    best = (F.desc("score"), F.desc("a"), "phrase")
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS)).alias("group")
    some = scored.select("*", group).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*best)))
    some = some.filter(F.col("rank") <= first)  # so many of each group, of which there is a fixed number
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= first)
    with_sizes = ranked.join(sent_if_small(stage(sizes, "language-sizes")), "lang")
    return with_sizes.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

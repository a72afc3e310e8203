"""Benchmark decontamination: passages of the corpus as BM25 queries against test items.

The items are the indexed documents, the corpus is the queries. A passage is a window of
words, twice as long as the longest item and moved by half, so every item that stands in
a text lies whole within one passage. An item's BM25 weights are divided by their sum:
its score is the share of its weight that the passage covers, and all items that score at
least ``SHARE`` are retrieved.

Posting lists are in blocks that know their highest weight, and so do ranges of items. A
passage whose words' highest weights add up to ``SHARE`` in no range can match nothing and
is skipped; for the others block-max WAND moves cursors over the lists and scores only items whose blocks can reach
the threshold. A retrieved item is split in question and answer; each must share
``OVERLAP`` of its five-word shingles with the passage.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import batch, mapped, prepare, texts_of
from quayside.session import stage

SHARE, OVERLAP, SHINGLE = 0.6, 0.8, 5
K1, B = 1.2, 0.75
#: Postings of a block.
BLOCK = 32
#: Ranges of items for which a word's highest weight is known.
RANGES = 256
#: Characters of item text that one index holds. More items make more indexes, one after another.
INDEX_CHARS = 2_000_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.?!]\s+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """All runs of five words; fewer words are one run."""
    return {tuple(words[i : i + SHINGLE]) for i in range(max(len(words) - SHINGLE + 1, 1))} if words else set()


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words: its last sentence is the answer, or its last third if it has but one."""
    sentences = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


@dataclass
class Cursor:
    """A place in one word's posting list."""

    items: list[int]
    weights: list[float]
    highs: list[float]  # highest weight of each block
    high: float
    at: int = 0

    def item(self) -> int | None:
        return self.items[self.at] if self.at < len(self.items) else None

    def block_of(self, item: int) -> tuple[float, int]:
        """Highest weight of the block that would hold ``item``, and the first item beyond that block."""
        block = bisect_left(self.items, item, self.at) // BLOCK
        if block >= len(self.highs):
            return 0.0, 1 << 62
        end = (block + 1) * BLOCK
        return self.highs[block], self.items[end] if end < len(self.items) else 1 << 62

    def seek(self, item: int) -> None:
        self.at = bisect_left(self.items, item, self.at)


class ItemIndex:
    """Inverted index of items, with weights that add up to one for each item."""

    def __init__(
        self, items: list[tuple[int, str]], frequency: dict[str, int] | None = None, total: int | None = None, mean: float | None = None, longest: int | None = None
    ):
        """``frequency``, ``total``, ``mean`` and ``longest`` length describe all items if these are but a part of them.

        Passages are as long for every part, so what is found does not depend on how items are dealt to parts.
        """
        words = [words_of(text) for _, text in items]
        self.ids = [item_id for item_id, _ in items]
        self.parts = [tuple(map(shingles, question_answer(text))) for _, text in items]
        self.longest = longest if longest is not None else max(map(len, words), default=0)
        frequency = frequency if frequency is not None else Counter(w for x in words for w in set(x))
        total = total if total is not None else len(items)
        mean = mean if mean is not None else sum(map(len, words)) / max(len(words), 1)
        lists: dict[str, tuple[list[int], list[float]]] = {}
        for number, x in enumerate(words):
            weights = {}
            for word, n in Counter(x).items():
                idf = math.log(1 + (total - frequency[word] + 0.5) / (frequency[word] + 0.5))
                weights[word] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(x) / mean))
            whole = sum(weights.values())
            for word, weight in weights.items():
                numbers, own = lists.setdefault(word, ([], []))
                numbers.append(number)
                own.append(weight / whole)
        self.terms = {word: i for i, word in enumerate(lists)}
        self.lists = [(n, w, [max(w[i : i + BLOCK]) for i in range(0, len(w), BLOCK)], max(w)) for n, w in lists.values()]
        ranges = max(min(RANGES, len(items)), 1)
        self.range_high = np.zeros((len(self.lists), ranges), np.float32)
        for term, (numbers, weights, *_) in enumerate(self.lists):
            np.maximum.at(self.range_high[term], np.array(numbers) * ranges // len(items), weights)

    def retrieve(self, terms: set[int]) -> list[tuple[int, float]]:
        """Block-max WAND: all items that score at least SHARE, with their scores."""
        cursors = [Cursor(*self.lists[t]) for t in sorted(terms)]
        found, enough = [], SHARE - 1e-9
        while True:
            cursors = sorted((c for c in cursors if c.at < len(c.items)), key=Cursor.item)
            bound, pivot = 0.0, None
            for i, c in enumerate(cursors):
                bound += c.high
                if bound >= enough:
                    pivot = i
                    break
            if pivot is None:
                return found
            item = cursors[pivot].item()
            while pivot + 1 < len(cursors) and cursors[pivot + 1].item() == item:
                pivot += 1
            blocks = [c.block_of(item) for c in cursors[: pivot + 1]]
            if sum(high for high, _ in blocks) < enough:
                beyond = min(end for _, end in blocks)
                if pivot + 1 < len(cursors):
                    beyond = min(beyond, cursors[pivot + 1].item())
                for c in cursors[: pivot + 1]:
                    c.seek(max(beyond, item + 1))
                continue
            score = 0.0
            for c in cursors[: pivot + 1]:
                c.seek(item)
                if c.item() == item:
                    score += c.weights[c.at]
                    c.at += 1
            if score >= enough:
                found.append((item, score))

    def promising(self, known: np.ndarray, step: int) -> list[int]:
        """Numbers of the passages (two steps each) that some range of items may match.

        A range's bound is the sum of its words' highest weights in it.
        """
        other, found = len(self.lists), []
        for low in range(0, len(known), 256 * step):  # long texts piece by piece, one step more each
            part = known[low : low + 257 * step]
            at = np.flatnonzero(part != other)
            once = np.sort(at // step * other + part[at])  # a word counts once a step
            once = once[np.flatnonzero(np.diff(once, prepend=-1))]
            if len(once):
                heads = np.flatnonzero(np.diff(once // other, prepend=-1))
                sums = np.zeros((-(-len(part) // step), self.range_high.shape[1]), np.float32)
                sums[once[heads] // other] = np.add.reduceat(self.range_high[once % other], heads, axis=0)
                pairs = sums[:-1] + sums[1:] if len(sums) > 1 else sums
                found += (np.flatnonzero(pairs.max(axis=1) >= SHARE - 1e-4) + low // step).tolist()
        return sorted(set(found))

    def matches(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Items that stand in a text: score, question overlap and answer overlap of the best passage."""
        words = words_of(text)
        find, other = self.terms.get, len(self.lists)
        known = np.fromiter((find(w, other) for w in words), np.int64, len(words))
        step = max(self.longest, 1)
        out: dict[int, tuple[float, float, float]] = {}
        for i in self.promising(known, step):
            a, b = i * step, (i + 2) * step
            terms = set(known[a:b].tolist()) - {other}
            if self.range_high[list(terms)].sum(axis=0).max() < SHARE - 1e-4:
                continue  # words that stand in both steps were counted twice
            passage: set[tuple[str, ...]] | None = None
            for item, score in self.retrieve(terms):
                passage = passage if passage is not None else spans(words[a:b])
                overlap = [len(part & passage) / len(part) if part else 1.0 for part in self.parts[item]]
                if min(overlap) >= OVERLAP:
                    out[item] = max(out.get(item, (0.0,)), (score, *overlap))
        return out


def spans(words: list[str]) -> set[tuple[str, ...]]:
    """All runs of one to five words: those of fewer than five match items' shorter parts."""
    return {tuple(words[i : i + n]) for n in range(1, SHINGLE + 1) for i in range(len(words) - n + 1)}


def item_indexes(items: DataFrame, chars: int = INDEX_CHARS) -> Iterator[ItemIndex]:
    """Indexes of bounded size over all items; document frequencies always count all items.

    Items without item_id or without a word are left out; equal rows count once.
    """
    spark = items.sparkSession
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("item_id").isNotNull() & F.col("text").rlike(r"(?U)\w"))
    rows = rows.distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= chars:
        found = [tuple(r) for r in rows.orderBy("item_id", "text").collect()]
        if found:
            yield ItemIndex(found)
        return

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = [words_of(t) for t in part.column("text").to_pylist()]
            yield batch(words=pa.array([sorted(set(x)) for x in found], pa.list_(pa.string())), n=pa.array(list(map(len, found)), pa.int64()))

    counts = stage(mapped(rows, counted, "words array<string>, n long"), "items")
    known = counts.agg(F.count("*"), F.avg("n"), F.max("n")).first()
    frequencies = stage(counts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "item-words")
    block, used = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        block.append((row.item_id, row.text))
        used += len(row.text)
        if used >= chars:
            yield part_index(spark, block, frequencies, *known)
            block, used = [], 0
    if block:
        yield part_index(spark, block, frequencies, *known)


def part_index(spark, block: list[tuple[int, str]], frequencies: DataFrame, total: int, mean: float, longest: int) -> ItemIndex:
    own = sorted({w for _, text in block for w in words_of(text)})
    own_words = spark.createDataFrame([(w,) for w in own], "word string")
    return ItemIndex(block, dict(map(tuple, frequencies.join(own_words, "word").collect())), total, mean, longest)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: items that stand in documents.

    A row per document and item, with the figures of the best passage; clean documents have
    none. Whole texts are read, null and empty ones match nothing. Rows without doc_id are
    left out; rows that repeat a doc_id give their rows each.
    """
    spark, found = docs.sparkSession, None
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    for index in item_indexes(items):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                out: list[tuple] = []
                for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                    out += [(doc_id, held.value.ids[i], *x) for i, x in sorted(held.value.matches(text).items())]
                columns = list(zip(*out, strict=True)) or [()] * 5
                yield batch(**{c: pa.array(v, t) for c, v, t in zip(("doc_id", "item_id", "score", "question_overlap", "answer_overlap"), columns, (pa.int64(),) * 2 + (pa.float64(),) * 3, strict=True)})

        part = mapped(texts_of(docs), run, schema)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], schema)


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents in which no item stands, with all their columns; no shuffle. Rows without doc_id go."""
    spark, kept = prepare(docs.sparkSession), docs.filter("doc_id IS NOT NULL")
    for index in item_indexes(items):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                yield rows.filter(pa.array([not held.value.matches(t) for t in rows.column("text").to_pylist()], pa.bool_()))

        kept = mapped(kept, run, docs.schema)
    return kept

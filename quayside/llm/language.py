"""Language identification by error-correcting output codes.

Each language has a codeword; for each bit a binary n-gram classifier tells the languages
with +1 from those with -1. With up to seven languages the code holds every way to part
them in two; with more, random rows whose mutual distance is the best of several draws.
A classifier's output is the mean over the text's 2- and 3-grams of
``log p(gram | +1) - log p(gram | -1)``, times a scale fitted on the sample. Decoding adds
up the exponential loss of each bit against each codeword, weighted by how often that
classifier is right on that language; the least loss wins. A text whose two least losses
are close is flagged ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import batch, mapped, prepare, remainder, sent_if_small, texts_of
from quayside.session import stage

GRAMS = 1 << 14
#: Most documents per language, and of all languages together, that are learned from.
SAMPLE, TOTAL = 600, 6000
#: Texts whose best language scores below this are ambiguous.
CERTAIN = 0.5
NONE = "und"


def code_matrix(n: int) -> np.ndarray:
    """Codewords of ``n`` languages as rows of +1 and -1; no column is constant."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        columns = [[1 if i == 0 or i in ones else -1 for i in range(n)] for k in range(n - 1) for ones in combinations(range(1, n), k)]
        return np.array(columns, np.int8).T
    width, draw, chosen, widest = int(np.ceil(10 * np.log2(n))), np.random.default_rng(3), None, -1
    for _ in range(50):
        code = draw.choice(np.array([-1, 1], np.int8), (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        nearest = (apart + np.eye(n, dtype=int) * width).min()
        if nearest > widest:
            chosen, widest = code, nearest
    return chosen


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram numbers of all texts, their bounds, and which texts hold a letter.

    Texts are lower-cased; every run of ASCII that is no letter counts as one space.
    """
    data = [_squeezed(t) for t in texts]
    lettered = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    sizes = np.array([len(x) for x in data], np.int64)
    two = raw[:-1] * np.uint32(0x9E3779B1) + raw[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + raw[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    shift = np.uint32(32 - int(GRAMS).bit_length() + 1)
    # a text of s bytes (s >= 3) has s - 2 places where both grams lie within it
    starts = np.cumsum(sizes) - sizes
    within = np.maximum(sizes - 2, 0)
    at = np.arange(within.sum()) - np.repeat(np.cumsum(within) - within, within) + np.repeat(starts, within)
    numbers = np.empty(2 * len(at), np.uint32)
    numbers[::2], numbers[1::2] = two[at] >> shift, three[at] >> shift
    return numbers, np.concatenate([[0], 2 * np.cumsum(within)]), lettered


_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _squeezed(text: str | None) -> bytes:
    """At least three bytes, so that every text has a gram."""
    return b" " + b" ".join((text or "").lower().encode().translate(_TABLE).split()) + b"  "


@dataclass
class Decoder:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # grams x bits
    scales: np.ndarray  # bits
    trust: np.ndarray  # languages x bits

    def outputs(self, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean weight of each text's grams, by bit."""
        out = np.empty((len(bounds) - 1, self.weights.shape[1]))
        for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)):
            total = np.zeros(out.shape[1])
            for low in range(a, b, 1 << 16):  # long texts piece by piece
                total += self.weights[numbers[low : min(low + (1 << 16), b)]].sum(axis=0, dtype=np.float64)
            out[i] = total / (b - a)
        return out

    def losses(self, outputs: np.ndarray) -> np.ndarray:
        margins = np.clip(outputs * self.scales, -4, 4)[:, None, :] * self.code
        return (self.trust * np.exp(-margins)).sum(axis=2)

    def decode(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        numbers, bounds, lettered = grams(texts)
        losses = self.losses(self.outputs(numbers, bounds))
        nearest = losses.argmin(axis=1)
        likeness = np.exp(-(losses - losses.min(axis=1, keepdims=True)) * len(self.languages))
        score = np.where(lettered, 1 / likeness.sum(axis=1), 0.0)
        names = [self.languages[i] if ok else NONE for i, ok in zip(nearest.tolist(), lettered.tolist(), strict=True)]
        return names, score, score < CERTAIN


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its grams and their counts."""
    for rows in batches:
        langs, texts = rows.column("lang").to_pylist(), rows.column("text").to_pylist()
        numbers, bounds, lettered = grams(texts)
        found = [np.unique(numbers[a:b], return_counts=True) for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
        keep = np.flatnonzero(lettered).tolist()
        yield batch(
            lang=pa.array([langs[i] for i in keep], pa.string()),
            numbers=pa.array([found[i][0] for i in keep], pa.list_(pa.int32())),
            counts=pa.array([found[i][1] for i in keep], pa.list_(pa.int64())),
        )


def fit(langs: list[str], numbers: list[np.ndarray], counts: list[np.ndarray]) -> Decoder:
    languages = sorted(set(langs))
    of = np.array([languages.index(x) for x in langs], np.int64)
    totals = np.full((len(languages), GRAMS), 0.0)
    for i, n, c in zip(of, numbers, counts, strict=True):
        totals[i, n] += c / c.sum()  # every document weighs the same
    share = totals / np.bincount(of, minlength=len(languages))[:, None] + 1e-6
    share /= share.sum(axis=1, keepdims=True)
    code = code_matrix(len(languages))
    up = (code.T > 0).astype(float) @ share / (code.T > 0).sum(axis=1, keepdims=True)
    down = (code.T < 0).astype(float) @ share / np.maximum((code.T < 0).sum(axis=1, keepdims=True), 1)
    weights = (np.log(np.maximum(up, 1e-9)) - np.log(np.maximum(down, 1e-9))).T
    outputs = np.array([(weights[n] * c[:, None]).sum(axis=0) / c.sum() for n, c in zip(numbers, counts, strict=True)])
    # a typical text of the sample comes out at 2, well on its side of zero
    scales = 2 / np.maximum(np.median(np.abs(outputs), axis=0), 1e-9)
    right = (np.sign(outputs) == code[of]).astype(float)
    trust = np.array([right[of == i].mean(axis=0) for i in range(len(languages))])
    trust = np.maximum(trust, 1e-3) / np.maximum(trust, 1e-3).sum(axis=1, keepdims=True)
    return Decoder(languages, code, weights.astype(np.float32), scales, trust)


def train(docs: DataFrame, sample: int = SAMPLE) -> Decoder | None:
    """Learn from text and lang of documents that are not held out; None without any.

    At most ``sample`` documents of each language are read, fewer of each where languages
    are many (``TOTAL``, but one at least), those first by a hash of doc_id. Ids are chosen before texts are read; they are few enough to be broadcast.
    """
    named = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # a language may hold a third of all rows: a first cut by hash keeps some 4 * sample rows of each
    sizes = stage(named.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    sample = min(sample, max(TOTAL // max(sizes.count(), 1), 1))
    draw = (F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5) * F.col("n") <= 4 * sample
    chosen = (
        named.filter(remainder(F.col("doc_id")) != 2)
        .join(sent_if_small(sizes), "lang")
        .filter(draw)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= sample)
        .select("doc_id")
        .distinct()
    )
    rows = texts_of(docs, F.col("lang").cast("string").alias("lang")).filter("lang IS NOT NULL")
    found = mapped(rows.join(F.broadcast(chosen), "doc_id", "left_semi"), count_rows, "lang string, numbers array<int>, counts array<long>").toArrow()
    if not len(found):
        return None
    return fit(
        found.column("lang").to_pylist(),
        [x.values.to_numpy() for x in found.column("numbers")],
        [x.values.to_numpy() for x in found.column("counts")],
    )


def identify(docs: DataFrame, decoder: Decoder | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row with a doc_id.

    Texts that are null, empty or without a letter are ``und`` with score 0 and count as
    ambiguous, and so does everything if nothing could be learned.
    """
    model = docs.sparkSession.sparkContext.broadcast(decoder)  # GRAMS numbers a bit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column("text").to_pylist()
            if model.value is None or not texts:
                names, scores, unsure = [NONE] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            else:
                names, scores, unsure = model.value.decode(texts)
            yield batch(doc_id=rows.column("doc_id"), lang_pred=pa.array(names, pa.string()), score=scores, ambiguous=unsure)

    found = mapped(texts_of(docs), run, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return found.select("doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents whose language is known and not ambiguous, with all their columns; no shuffle."""
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if model.value is not None and len(rows):
                yield rows.filter(pa.array(~model.value.decode(rows.column("text").to_pylist())[2]))

    return mapped(docs.filter("doc_id IS NOT NULL"), run, docs.schema)

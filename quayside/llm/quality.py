"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its distinct words, hashed to ``WORDS`` numbers and scaled to
length one, then statistics of its structure, then its metadata (``n_chars``). The score
is the logistic of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairs are
summed in linear time as half of ``sum_f (sum_i v_if x_i)**2 - sum_i (v_if x_i)**2``.

Labels are read only from documents that ``remainder`` does not hold out. Weights are
fitted on at most ``SAMPLE`` of them, taken by a hash of doc_id; scoring reads all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import batch, mapped, remainder, text_bytes, texts_of

WORDS = 1 << 14
FACTORS = 8
#: Most labelled documents that the weights are fitted on.
SAMPLE = 6000
EPOCHS, STEP_ROWS, RATE, DECAY = 12, 32, 0.05, 1e-4
THRESHOLD = 0.7
#: Classes of bytes that the statistics count.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r",
    "line": b"\n",
    "stop": b".,;:'\"()-?",
    "bang": b"!",
    "bar": b"|",
    "mark": b"#$%&*+/<=>@[\\]^_`{}~",
}
STATISTICS = len(CLASSES) + 7
_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate(CLASSES.values(), 1):
    _CLASS[list(_chars)] = _i


def statistics(text: bytes, words: list[bytes], distinct: int, n_chars: int | None) -> list[float]:
    n = len(text) or 1
    counts = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[1:]
    lines = text.split(b"\n")
    long = [x for x in lines if x]
    return [
        *np.sqrt(counts / n).tolist(),
        np.log1p(len(text)) / 10,
        np.log1p(len(words)) / 10,
        len(text) / (len(words) or 1) / 10,
        distinct / (len(words) or 1),
        len(set(long)) / (len(long) or 1),
        np.log1p(len(text) / len(lines)) / 10,
        np.log1p(max(n_chars or 0, 0)) / 10,
    ]


def features(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, values and each row's bounds in them."""
    view, bounds = text_bytes(rows.column("text"))
    bounds = bounds.tolist()
    crc, numbers, values, ends = zlib.crc32, [], [], [0]
    tail = np.arange(WORDS, WORDS + STATISTICS)
    for i, j, n_chars in zip(bounds, bounds[1:], rows.column("n_chars").to_pylist(), strict=False):
        text = bytes(view[i:j])
        words = text.split()
        distinct = set(words)
        hashed = np.unique(np.fromiter(map(crc, distinct), np.int64, len(distinct)) & (WORDS - 1))
        numbers += [hashed, tail]
        values += [np.full(len(hashed), 1 / np.sqrt(len(hashed) or 1)), np.array(statistics(text, words, len(distinct), n_chars))]
        ends.append(ends[-1] + len(hashed) + STATISTICS)
    return np.concatenate(numbers), np.concatenate(values), np.array(ends)


def row_sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over each row's values; every row has some."""
    return np.add.reduceat(x, bounds[:-1], axis=0)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, numbers: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums before the logistic, and what the gradient needs of them."""
        scaled = self.factors[numbers] * values[:, None]
        total = row_sums(scaled, bounds)
        pairs = 0.5 * (total**2 - row_sums(scaled**2, bounds)).sum(axis=1)
        return self.bias + row_sums(self.linear[numbers] * values, bounds) + pairs, scaled, total

    def scores(self, numbers: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return logistic(self.raw(numbers, values, bounds)[0])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(numbers: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Adaptive gradient steps on the log loss, rows in a fixed random order."""
    draw = np.random.default_rng(5)
    n = WORDS + STATISTICS
    machine = Machine(0.0, np.zeros(n), draw.normal(0, 0.05, (n, FACTORS)))
    seen_bias, seen_linear, seen_factors = 1e-8, np.full(n, 1e-8), np.full((n, FACTORS), 1e-8)
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), STEP_ROWS):
            chosen = order[at : at + STEP_ROWS]
            sizes = np.array([len(numbers[i]) for i in chosen])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            f, x = np.concatenate([numbers[i] for i in chosen]), np.concatenate([values[i] for i in chosen])
            raw, scaled, total = machine.raw(f, x, bounds)
            error = (logistic(raw) - labels[chosen]) / len(chosen)
            each = np.repeat(error, sizes)
            used, where = np.unique(f, return_inverse=True)
            linear = np.bincount(where, each * x) + DECAY * machine.linear[used]
            slopes = (each * x)[:, None] * (np.repeat(total, sizes, axis=0) - scaled)
            pairs = np.stack([np.bincount(where, s) for s in slopes.T], axis=1) + DECAY * machine.factors[used]
            seen_bias += error.sum() ** 2
            seen_linear[used] += linear**2
            seen_factors[used] += pairs**2
            machine.bias -= RATE * error.sum() / np.sqrt(seen_bias)
            machine.linear[used] -= RATE * linear / np.sqrt(seen_linear[used])
            machine.factors[used] -= RATE * pairs / np.sqrt(seen_factors[used])
    return machine


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        if len(rows):
            numbers, values, ends = features(rows)
            offsets = pa.array(ends, pa.int32())
            yield batch(
                label=rows.column("label"),
                numbers=pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                values=pa.ListArray.from_arrays(offsets, pa.array(values, pa.float32())),
            )


def with_metadata(docs: DataFrame) -> DataFrame:
    known = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    return texts_of(docs, known.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on documents that are not held out and have a quality label.

    Without any label the machine scores everything one half. Rows that repeat a doc_id
    in ``labels`` count once, with their highest label.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter(remainder(F.col("doc_id")) != 2)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = mapped(with_metadata(docs).join(F.broadcast(chosen), "doc_id"), feature_rows, "label int, numbers array<int>, values array<float>")
    found = rows.toArrow()
    numbers = [x.values.to_numpy() for x in found.column("numbers")]
    values = [x.values.to_numpy().astype(np.float64) for x in found.column("values")]
    return fit(numbers, values, found.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row with a doc_id.

    Null texts count as empty; an empty text is scored by its statistics.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)  # WORDS * (FACTORS + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = model.value.scores(*features(rows)) if len(rows) else np.empty(0)
            yield batch(doc_id=rows.column("doc_id"), score=found)

    scored = mapped(with_metadata(docs), run, "doc_id long, score double")
    held = remainder(F.col("doc_id")) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

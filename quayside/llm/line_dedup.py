"""Removal of repeated lines, told by overlapping windows of three lines.

A window is three consecutive lines of one document; lines end at line feeds and are
compared as they are. Of equal windows the first stays (smallest doc_id, then line);
the lines of all later ones are covered, and covered positions are merged and removed.
Documents of fewer than three lines hold no window and stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import batch, mapped, texts_of

WINDOW = 3


def line_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, at, one, two``: every window's first line number and 128 bits of hash.

    Line numbers are chained into the second hash as a constant first value only,
    which gives it another seed.
    """
    lines = F.split("text", "\n", -1)
    places = F.expr(f"CASE WHEN size(lines) >= {WINDOW} THEN sequence(0, size(lines) - {WINDOW}) END")
    window = [F.col("lines")[F.col("at") + i] for i in range(WINDOW)]
    return (
        texts_of(docs)
        .select("doc_id", lines.alias("lines"))
        .select("doc_id", "lines", F.explode(places).alias("at"))
        .select("doc_id", "at", F.xxhash64(*window).alias("one"), F.xxhash64(F.lit(WINDOW), *window).alias("two"))
    )


def remove_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        out: dict[str, list] = {c: [] for c in ("n_lines", "spans", "kept")}
        for text, later in zip(rows.column("text").to_pylist(), rows.column("later").to_pylist(), strict=True):
            lines = text.split("\n")
            change = np.zeros(len(lines) + WINDOW + 1, np.int64)
            at = np.unique(np.array([x for x in later or () if x + WINDOW <= len(lines)], np.int64))
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
            covered = np.cumsum(change)[: len(lines)] > 0
            edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0)).tolist()
            out["n_lines"].append(len(lines))
            out["spans"].append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            out["kept"].append("\n".join(x for x, gone in zip(lines, covered.tolist(), strict=True) if not gone))
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield batch(
            doc_id=rows.column("doc_id"),
            n_lines=pa.array(out["n_lines"], pa.int64()),
            spans=pa.array(out["spans"], span),
            kept=pa.array(out["kept"], pa.string()),
        )


def line_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, spans, kept``: removed line ranges (start, stop) and the text that is left.

    Null texts count as empty, and an empty text as one empty line. Rows without doc_id
    are left out. Rows that share a doc_id count as one place: they are not repeats of
    each other, and share the ranges removed. A window that a third of all documents
    share sends one row per map task to find its first place; where later places are
    looked up, the join splits it.
    """
    windows = line_windows(docs)
    firsts = windows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n"))
    later = (
        windows.join(firsts.filter("n > 1"), ["one", "two"])
        .filter((F.col("doc_id") != F.col("first.doc_id")) | (F.col("at") != F.col("first.at")))
        .groupBy("doc_id")
        .agg(F.collect_list("at").alias("later"))
    )
    joined = texts_of(docs).join(later, "doc_id", "left")
    return mapped(joined, remove_lines, "doc_id long, n_lines long, spans array<struct<start:int,stop:int>>, kept string")

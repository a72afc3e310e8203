"""Feeds a table to a stream in time order, one slice per run of the query."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.functions.time import timestamp_literal

# Slice borders inside the time range of the test events.
BORDERS = (datetime(2024, 1, 11), datetime(2024, 1, 21))


def slices(
    rows: DataFrame, ts_col: str = "arrived_at", borders: Sequence[datetime] = BORDERS
) -> list[DataFrame]:
    ts = F.col(ts_col)
    edges = [None, *[timestamp_literal(b) for b in borders], None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.filter(ts >= low)
        if high is not None:
            part = part.filter(ts < high)
        parts.append(part)
    return parts


def replay(parts: Sequence[DataFrame], inbox: str, start: Callable[[], StreamingQuery]) -> None:
    """Append each part to ``inbox`` and run the stream until it has read it.

    Every run restarts from the checkpoint of the one before.
    """
    for part in parts:
        part.write.mode("append").parquet(inbox)
        start().awaitTermination()

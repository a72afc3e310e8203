"""Stateful stream operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quayside.catalogue import STUCK_THRESHOLD, STUCK_TOLERANCE, struct_of
from quayside.operators.stuck import IDLE_GROUPS

_STATE = struct_of("last_value DOUBLE, repeat_count BIGINT")


def dedupe_stream(
    df: DataFrame, keys: Sequence[str], ts_col: str = "event_timestamp", delay: str = "1 hour"
) -> DataFrame:
    """Drop copies within and across micro-batches, and rows behind the watermark."""
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def run_lengths(
    values: np.ndarray, last: float | None, count: int, tol: float
) -> np.ndarray:
    """Position of each value in its run of near-equal neighbours, after ``last``."""
    previous = np.concatenate([[np.nan if last is None else last], values[:-1]])
    with np.errstate(invalid="ignore"):
        same = np.abs(values - previous) < tol
    index = np.arange(len(values))
    start = np.maximum.accumulate(np.where(same, -1, index))
    return np.where(start < 0, index + 1 + count, index - start + 1)


def stuck_stream(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    value_col: str,
    threshold: int = STUCK_THRESHOLD,
    tol: float = STUCK_TOLERANCE,
    *,
    dedupe_on: Sequence[str] = (),
) -> DataFrame:
    """Streaming twin of ``stuck_runs``, with the runs in Spark's state store.

    Inside a micro-batch rows go by ``order_cols``; across batches by arrival, so
    a late row is compared with the last value processed. ``dedupe_on`` drops a
    key's copies within the batch first.

    Rows without key or value pass through unflagged, as in ``stuck_runs``; those
    without key have no state and are dealt to ``IDLE_GROUPS`` groups. NaN is a value
    that ends a run. A key's other rows of one micro-batch meet in one Python call:
    the source's rate limit bounds them. ``start_clean_stream`` has no such limit and
    is the one to use for large batches.
    """
    keys, order_cols, dedupe_on = list(keys), list(order_cols), list(dedupe_on)
    columns = df.columns
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("run_length", T.LongType()),
            T.StructField("is_stuck", T.BooleanType()),
        ]
    )

    is_double = isinstance(df.schema[value_col].dataType, T.DoubleType)

    def result(rows: pd.DataFrame, run_length: np.ndarray, idle: np.ndarray, is_stuck: np.ndarray) -> pd.DataFrame:
        out = {c: rows[c].array for c in columns}
        if is_double:  # a NaN stays one
            values = rows[value_col].to_numpy(dtype=float, na_value=np.nan)
            out[value_col] = pd.arrays.FloatingArray(values, rows["_missing"].to_numpy(dtype=bool))
        out["run_length"], out["is_stuck"] = pd.arrays.IntegerArray(run_length, idle), is_stuck
        return pd.DataFrame(out, copy=False)

    def advance(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if key[-1] >= 0:
            for rows in frames:
                n = len(rows)
                yield result(rows, np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, bool))
            return
        last, count = state.get if state.exists else (None, 0)
        parts = [f for f in frames if len(f)]
        rows = parts[0] if len(parts) == 1 else pd.concat(parts)
        rows = rows.sort_values(order_cols, kind="stable", na_position="first")
        if dedupe_on:
            rows = rows.drop_duplicates(dedupe_on, keep="first")
        # one frame a key: for short sequences, frames cost more than their rows
        live = ~rows["_missing"].to_numpy(dtype=bool)
        lengths, stuck = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        if live.any():
            values = rows[value_col].to_numpy(dtype=float, na_value=np.nan)[live]
            lengths[live] = run_lengths(values, last, count, tol)
            state.update((float(values[-1]), int(lengths[live][-1])))
            stuck[live] = ~(np.abs(values) <= tol) & (lengths[live] >= threshold)
        yield result(rows, lengths, ~live, stuck)

    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    spread = F.pmod(F.xxhash64(*order_cols), F.lit(IDLE_GROUPS))
    # pandas shows a missing number as NaN, so the two are told apart before
    marked = df.withColumns(
        {
            "_missing": F.col(value_col).isNull(),
            "_idle": F.when(no_key, spread).otherwise(F.lit(-1)).cast("int"),
        }
    )
    return marked.groupBy(*keys, "_idle").applyInPandasWithState(
        advance, schema, _STATE, "append", GroupStateTimeout.NoTimeout
    )

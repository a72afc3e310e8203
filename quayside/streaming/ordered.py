"""Stateful stream operators that know the watermark: readings in their place, and late rows by name."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quayside.catalogue import STUCK_THRESHOLD, STUCK_TOLERANCE, struct_of
from quayside.operators.stuck import IDLE_GROUPS

# The process in which Spark asks a processor for its states does not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RUN = struct_of("last_value DOUBLE, repeat_count BIGINT")
#: Why a row did not pass ``admit``.
LATE, COPY = "en_retard", "doublon"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own choice comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class OrderedRuns(StatefulProcessor):
    """Rows of a key wait until the watermark has passed them, then go by time.

    States: ``waiting``, the rows that may still be overtaken, and ``run``, the last value
    that left and the length of its run.
    """

    def __init__(self, columns: T.StructType, at: str, order: Sequence[str], value: str, threshold: int, tol: float, retire_ms: int):
        self.columns, self.at, self.order, self.value = columns, columns.names.index(at), [columns.names.index(c) for c in order], columns.names.index(value)
        self.threshold, self.tol, self.retire_ms = threshold, tol, retire_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.columns)
        self.run = handle.getValueState("run", RUN)
        self.settled: set = set()  # keys whose other timers of this batch have nothing to do

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.run.update((initialState.last_value, initialState.repeat_count))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new = [tuple(r)[:-1] for r in rows]  # without the clock
        self.settled.discard(key)
        self.waiting.appendList(new)
        # one millisecond on, as a row is passed when the watermark lies behind it
        self.handle.registerTimer(min(r[self.at] for r in new) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if key in self.settled:
            return
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: [(r[i] is not None, r[i]) for i in self.order])
        ready = [r for r in rows if r[self.at] < passed]
        if ready:
            rest = rows[len(ready) :]
            if rest:
                self.settled.add(key)
                self.waiting.put(rest)
                self.handle.registerTimer(rest[0][self.at] // 1000 + 1)
            else:
                self.waiting.clear()
                self.handle.registerTimer(ready[-1][self.at] // 1000 + self.retire_ms)
            yield from self.measured(ready)
        elif not rows and self.run.exists() and not list(t for t in self.handle.listTimers() if t > expiredTimerInfo.getExpiryTimeInMs()):
            self.run.clear()  # an id that has been silent for so long

    def measured(self, rows: list[tuple]) -> Iterator[Row]:
        last, count = self.run.get() or (None, 0)  # one call to the store
        for row in rows:
            value = row[self.value]
            count = count + 1 if last is not None and abs(value - last) < self.tol else 1
            last = value
            stuck = abs(value) > self.tol and count >= self.threshold
            yield Row(**dict(zip(self.columns.names, row, strict=True)), run_length=count, is_stuck=stuck)
        self.run.update((last, count))

    def close(self) -> None:
        pass


def stuck_stream_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    value_col: str,
    delay: str = "1 hour",
    threshold: int = STUCK_THRESHOLD,
    tol: float = STUCK_TOLERANCE,
    *,
    initial: DataFrame | None = None,
    retire: int = 7 * 24 * 3600,
) -> DataFrame:
    """``stuck_runs`` over a stream whose readings arrive out of order by ``delay`` at most.

    ``order_cols`` starts with the event time. A reading comes out, flagged, once the
    watermark has passed it, in its place among its key's readings whatever batch brought
    it; readings behind the watermark are dropped, and ``admit`` names them. Rows without
    key or value are dropped here, as they belong to no run. ``initial`` (keys, last_value,
    repeat_count) is the state that batch loads left. A key silent for ``retire`` seconds of
    event time loses its state. Start the query within ``rocksdb(spark)``.
    """
    ts, types = order_cols[0], {f.name: f.dataType for f in df.schema.fields}
    times = [c for c, t in types.items() if isinstance(t, T.TimestampType)]
    live = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, *order_cols[:1], value_col]])
    rows = df.filter(live).withColumn(value_col, F.col(value_col).cast("double")).withColumn("_clock", F.col(ts))
    rows = rows.withWatermark("_clock", delay).withColumns({c: F.unix_micros(c) for c in times})
    held = T.StructType([f for f in rows.schema.fields if f.name != "_clock"])
    out = T.StructType([*held.fields, T.StructField("run_length", T.LongType()), T.StructField("is_stuck", T.BooleanType())])
    known = None if initial is None else initial.select(*keys, F.col("last_value").cast("double"), F.col("repeat_count").cast("long")).groupBy(*keys)

    processor = OrderedRuns(held, ts, order_cols, value_col, threshold, tol, retire * 1000)
    flagged = rows.groupBy(*keys).transformWithState(processor, out, "Append", "EventTime", known)
    return flagged.withColumns({c: F.timestamp_micros(c) for c in times})


def admit(
    df: DataFrame, keys: Sequence[str], ts_col: str = "event_timestamp", delay: str = "1 hour"
) -> DataFrame:
    """All rows of a stream with ``verdict``: null, or ``LATE`` or ``COPY``, so that none is lost silently.

    A row behind the watermark (``delay`` behind the latest time of earlier batches) is
    late; a second row of the same ``keys`` and time, in whatever batch, is a copy. Of a
    batch's copies the first in arrival order stays. Rows without key or time are neither.
    A key's state is the times it has had since the watermark, as of its last batch. Rows of
    one key and micro-batch meet in one Python call, which the source's rate limit bounds.
    """
    columns, keys = df.columns, list(keys)
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*keys, ts_col]])
    spread = F.pmod(F.xxhash64(F.struct(*columns)), F.lit(IDLE_GROUPS)).cast("int")
    marked = df.withWatermark(ts_col, delay).withColumns(
        {"_idle": F.when(no_key, spread).otherwise(F.lit(-1)), "_at": F.unix_micros(ts_col)}
    )
    schema = T.StructType([*df.schema.fields, T.StructField("verdict", T.StringType())])

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[-1] >= 0:
            for rows in frames:
                yield rows[columns].assign(verdict=None)
            return
        passed = state.getCurrentWatermarkMs() * 1000
        seen = {t for t in (state.get[0] if state.exists else ()) if t >= passed}
        for rows in frames:
            verdicts = []
            for at in rows["_at"].tolist():
                verdicts.append(LATE if at < passed else COPY if at in seen else None)
                seen.add(at)
            yield rows[columns].assign(verdict=pd.array(verdicts, dtype="object"))
        state.update((sorted(t for t in seen if t >= passed),))

    return marked.groupBy(*keys, "_idle").applyInPandasWithState(
        judge, schema, "seen ARRAY<BIGINT>", "append", GroupStateTimeout.NoTimeout
    )

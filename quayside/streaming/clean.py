"""The cleaning stream: all kinds in one query, two idempotent writes per batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.catalogue import KINDS, STUCK_THRESHOLD, Kind, struct_of
from quayside.operators.counts import observe_counts, outcome_counts
from quayside.operators.quality import split_valid, to_rejected_mixed, union_rejects
from quayside.operators.stuck import ROWS_PER_PIECE
from quayside.plans.cleaning import (
    STATE_KEYS,
    flag_stuck,
    next_state,
    pieces_of,
    validate_messages,
)
from quayside.sinks.keyed import KeyedLog
from quayside.sinks.state import StuckState
from quayside.sinks.tables import clean_rows, write_clean, write_ids, write_rejected
from quayside.streaming.ordered import COPY, LATE, admit

log = logging.getLogger(__name__)
COUNTS = ("valid_count", "rejected_count", "stuck_count")
BATCH_COLUMNS = ", ".join(["batch_id BIGINT", *(f"{c} BIGINT" for c in COUNTS)])


def batch_log(path: str) -> KeyedLog:
    return KeyedLog(path, ["batch_id"], struct_of(f"{BATCH_COLUMNS}, finished_at TIMESTAMP"))


def batch_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """``batch_id``, counts and ``finished_at`` of every batch that a stream has written."""
    return batch_log(path).before(spark)


def start_clean_stream(
    messages: DataFrame,
    *,
    clean_path: str,
    rejected_path: str,
    checkpoint: str,
    kinds: Sequence[Kind] = KINDS,
    threshold: int = STUCK_THRESHOLD,
    dedupe: str = "per_batch",
    delay: str = "1 hour",
    trigger: dict | None = None,
    rows_per_piece: int | None = ROWS_PER_PIECE,
    on_counts: Callable[[int, dict], None] | None = None,
    begin_from: DataFrame | None = None,
    counts_path: str | None = None,
) -> StreamingQuery:
    """Start cleaning ``topic, value, offset`` messages into the two tables.

    ``dedupe="per_batch"`` drops copies inside a micro-batch and takes late rows as
    any other. ``"watermark"`` drops copies across batches too; valid rows more than
    ``delay`` behind, of which it cannot tell, go to the dead letter as ``LATE``.

    Stuck runs use the batch operator with the state of the batch before, so a
    busy equipment is split over tasks here as well and no row passes through
    Python. ``checkpoint`` must be a folder that all executors share. A stream without
    a state of its own starts from ``begin_from`` (``plans.etl.loaded_state``: where the
    batch loads ended), so that runs go on from loads to the stream. ``counts_path`` keeps
    every batch's counts (``batch_counts``), over restarts, a repeated batch's once.
    """
    validated = observe_counts(validate_messages(messages, kinds), "validation")
    if dedupe == "watermark":
        valid, rejected = split_valid(validated)
        admitted = admit(valid, STATE_KEYS, delay=delay).filter(~F.col("verdict").eqNullSafe(COPY))
        late = F.when(F.col("verdict") == LATE, F.lit(LATE))
        validated = union_rejects(rejected, admitted.withColumn("reject_reason", late).drop("verdict"))
    elif dedupe != "per_batch":
        raise ValueError(f"dedupe must be 'per_batch' or 'watermark', not {dedupe!r}")
    # batches are numbered per checkpoint, so the checkpoint names the writer
    writer = f"stream-{md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"
    state = StuckState(f"{checkpoint.rstrip('/')}/stuck-state")
    state.begin(begin_from)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            kept.append(df.persist())
            return df

        try:
            batch = keep(batch)
            arrived = batch.count()
            if not arrived:  # nothing to write, and the state stays as it is
                return
            valid, rejected = split_valid(batch)
            prior = state.before(spark, batch_id, only=valid)
            pieces = pieces_of(valid, arrived, rows_per_piece)
            flagged = flag_stuck(
                valid, kinds, threshold, prior=prior, rows_per_piece=pieces, keep=keep
            )
            outcome = keep(union_rejects(rejected, flagged))
            # Fills the cache in one pass; the three writes below read from it.
            counts = outcome.agg(*outcome_counts()).first().asDict()
            clean, bad = split_valid(outcome)
            rows = clean_rows(clean, kinds)
            write_clean(rows, clean_path, batch_id, writer)
            write_ids(rows, clean_path, batch_id, writer)
            write_rejected(to_rejected_mixed(bad, kinds), rejected_path, batch_id, writer)
            state.write(next_state(outcome), batch_id)
            state.forget(spark, batch_id)
            log.info("batch %d: %s", batch_id, counts)
            if counts_path is not None:
                row = (batch_id, *(counts[c] for c in COUNTS))
                counted = spark.createDataFrame([row], BATCH_COLUMNS)
                batch_log(counts_path).write(counted.withColumn("finished_at", F.current_timestamp()), batch_id)
            if on_counts is not None:
                on_counts(batch_id, counts)
        finally:
            for df in kept:
                df.unpersist()

    return (
        validated.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows that a stream of ``dedupe_stream`` dropped in the batches it still reports:
    the last 100 since it was started (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )

"""Messages in, rows with a final verdict out (batch)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.catalogue import KINDS, STUCK_SENSOR, STUCK_THRESHOLD, Kind
from quayside.operators.dedupe import dedupe_first, first_of_sorted
from quayside.operators.quality import split_valid, union_rejects, with_reject_reason_mixed
from quayside.operators.stuck import ROWS_PER_PIECE, state_after, stuck_runs
from quayside.session import stage
from quayside.sources.topics import parse_mixed

STATE_KEYS = ["equipment_type", "equipment_id"]
READING_KEY = [*STATE_KEYS, "event_timestamp"]


def validate_messages(
    messages: DataFrame,
    kinds: Sequence[Kind] = KINDS,
    state_domain: Sequence[str] | None = None,
) -> DataFrame:
    """Parse, normalise, validate: one narrow pass, the same for batch and stream."""
    return with_reject_reason_mixed(parse_mixed(messages, kinds), kinds, state_domain)


def watched_value(kinds: Sequence[Kind] = KINDS):
    """Each kind's monitored field, as one column over wide rows."""
    return F.coalesce(
        *[F.when(F.col("equipment_type") == k.name, F.col(k.watched)) for k in kinds]
    )


def pieces_needed(rows: int, rows_per_piece: int | None) -> int | None:
    """No key can be hot when all rows together fit one piece."""
    return None if rows_per_piece is None or rows <= rows_per_piece else rows_per_piece


def pieces_of(valid: DataFrame, rows: int, rows_per_piece: int | None) -> int | None:
    """``rows_per_piece`` if a key of ``valid``, copies included, has more of its ``rows``; else None."""
    pieces = pieces_needed(rows, rows_per_piece)
    if pieces is None:
        return None
    hot = valid.groupBy(*STATE_KEYS).agg(F.count("*").alias("_n")).filter(F.col("_n") > pieces)
    return None if hot.isEmpty() else pieces


def flag_stuck(
    valid: DataFrame,
    kinds: Sequence[Kind] = KINDS,
    threshold: int = STUCK_THRESHOLD,
    *,
    order_col: str = "offset",
    prior: DataFrame | None = None,
    rows_per_piece: int | None = ROWS_PER_PIECE,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Deduplicate valid rows, then mark the stuck ones in ``reject_reason``.

    Adds ``watched`` and ``run_length``, from which the next state is taken.
    Looking for hot keys reads the deduplicated rows more than once; ``keep``
    (persist, or stage) saves deduplicating them again each time. Without a hot key
    (``rows_per_piece=None``, ``pieces_of``) rows are dealt and sorted by equipment at once,
    for copies, runs and ``prior`` alike.
    """
    if rows_per_piece is None:
        survivors = first_of_sorted(valid, STATE_KEYS, "event_timestamp", [order_col])
    else:
        survivors = dedupe_first(valid, READING_KEY, [order_col])
    survivors = survivors.withColumn("watched", watched_value(kinds))
    if keep is not None and rows_per_piece is not None:
        survivors = keep(survivors)
    flagged = stuck_runs(
        survivors,
        STATE_KEYS,
        ["event_timestamp", order_col],
        "watched",
        threshold,
        prior=prior,
        rows_per_piece=rows_per_piece,
        dealt=rows_per_piece is None,
    )
    return flagged.withColumn(
        "reject_reason", F.when(F.col("is_stuck"), STUCK_SENSOR)
    ).drop("is_stuck")


def clean_batch(
    messages: DataFrame,
    kinds: Sequence[Kind] = KINDS,
    threshold: int = STUCK_THRESHOLD,
    rows_per_piece: int | None = ROWS_PER_PIECE,
    prior: DataFrame | None = None,
) -> DataFrame:
    """All rows but dropped duplicates, each with its final ``reject_reason``.

    Rejected rows bypass deduplication and stuck detection: they have no usable
    key, and all of them are kept. Validated rows are staged, so payloads are
    parsed once and each later step reads only the columns it needs. ``prior`` is
    the stuck state that earlier loads left (``next_state``), so runs go on.
    """
    validated = stage(validate_messages(messages, kinds), "validated")
    return clean_validated(validated, kinds, threshold, rows_per_piece, prior)


def clean_validated(
    validated: DataFrame,
    kinds: Sequence[Kind] = KINDS,
    threshold: int = STUCK_THRESHOLD,
    rows_per_piece: int | None = ROWS_PER_PIECE,
    prior: DataFrame | None = None,
) -> DataFrame:
    """``clean_batch`` from validated rows on; they are read more than once."""
    valid, rejected = split_valid(validated)
    pieces = pieces_of(valid, validated.count(), rows_per_piece)
    flagged = flag_stuck(
        valid,
        kinds,
        threshold,
        prior=prior,
        rows_per_piece=pieces,
        keep=lambda survivors: stage(survivors, "survivors"),
    )
    return union_rejects(rejected, flagged)


def next_state(outcome: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Stuck state after a cleaned batch, to be the next one's ``prior``."""
    return state_after(outcome, STATE_KEYS, ["event_timestamp", "offset"], "watched", prior)

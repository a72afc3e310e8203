"""Stuck-value detection over sequences of readings (batch).

Per key, rows in order: a row belongs to the run of the row before it when the
two values differ by less than ``tol``. From the ``threshold``-th row of a run
on, rows are stuck unless the value is zero (a machine at rest).

One key may hold a large share of all rows, and one window group is one task.
Keys with more than ``rows_per_piece`` rows are therefore cut into time slots
(*pieces*). Runs are first measured inside each piece; what a piece hands to
the next one (last value, length of its last run) is a row per piece, chained
in a second, small window and added to the rows of the piece's first run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quayside.catalogue import STUCK_THRESHOLD, STUCK_TOLERANCE

ROWS_PER_PIECE = 5_000_000
# From this many rows per piece on, hot keys are few enough to broadcast: a millionth of the rows.
FEW_HOT_KEYS = 1_000_000
# Slot widths a hot key may be cut into, in minutes; the widest that fits is taken.
SLOT_MINUTES = (1440, 360, 60, 10, 1)
# Rows without key or value take no part; they are spread over this many groups.
IDLE_GROUPS = 1024
_WHOLE = -(2**62)
_BEFORE = -(2**63)


def _near(a: Column, b: Column, tol: float) -> Column:
    return F.abs(a - b) < tol


def _run() -> Column:
    """Position in the run, as far as it lies inside the piece."""
    return F.col("_rn") - F.col("_start") + 1


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _minute(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(60_000_000))


def _sent(hot: DataFrame, rows_per_piece: int) -> DataFrame:
    """``hot`` has fewer rows than ``rows / rows_per_piece``; with small pieces Spark decides."""
    return F.broadcast(hot) if rows_per_piece >= FEW_HOT_KEYS else hot


def hot_slots(
    rows: DataFrame, keys: Sequence[str], ts_col: str, rows_per_piece: int
) -> DataFrame:
    """Keys above ``rows_per_piece`` rows, with the slot width that fits them.

    Counts combine before the shuffle. Fewer than ``rows / rows_per_piece`` keys
    can qualify, which bounds the result (200 000 rows for 10^12 readings);
    when none does, the second scan is not run at all.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = counts.filter(F.col("_n") > rows_per_piece).select(*keys)
    minutes = (
        rows.join(_sent(hot, rows_per_piece), list(keys), "left_semi")
        .groupBy(*keys, _minute(F.col(ts_col)).alias("_minute"))
        .agg(F.count("*").alias("_n"))
    )
    # Each width divides the next, so one shuffle and one sort serve all windows: the finest comes first.
    slots = {f"_at{w}": F.floor(F.col("_minute") / w) for w in SLOT_MINUTES[:-1]}
    counted = minutes.withColumns(slots).repartition(*keys, next(iter(slots)))
    counted = counted.withColumn(f"_n{SLOT_MINUTES[-1]}", F.col("_n"))
    for i in reversed(range(len(slots))):
        whole = Window.partitionBy(*keys, *list(slots)[: i + 1])
        counted = counted.withColumn(f"_n{SLOT_MINUTES[i]}", F.sum("_n").over(whole))
    fullest = counted.groupBy(*keys).agg(*[F.max(f"_n{w}").alias(f"_n{w}") for w in SLOT_MINUTES])
    fits = [F.when(F.col(f"_n{w}") <= rows_per_piece, w) for w in SLOT_MINUTES]
    return fullest.select(*keys, F.coalesce(*fits, F.lit(min(SLOT_MINUTES))).alias("_width"))


def _from_state(prior: DataFrame, keys: list[str], piece: int) -> DataFrame:
    return prior.select(
        *keys,
        F.lit(piece).alias("_piece"),
        F.col("last_value").alias("_last"),
        F.col("repeat_count").cast("bigint").alias("_count"),
    )


def _handed_over(
    measured: DataFrame,
    keys: list[str],
    order_cols: Sequence[str],
    value_col: str,
    tol: float,
    prior: DataFrame | None,
) -> DataFrame:
    """(keys, piece) → last value and run length before that piece of a hot key."""
    ends = F.struct(F.col(value_col).alias("last"), _run().alias("count"), "_start")
    pieces = (
        measured.filter(~F.col("_idle") & (F.col("_piece") != _WHOLE))
        .groupBy(*keys, "_idle", "_piece")  # as the rows lie
        .agg(F.min("_head").alias("_head"), F.max_by(ends, F.struct(*order_cols)).alias("_end"))
        .select(
            *keys,
            "_piece",
            F.col("_end.last").alias("_last"),
            F.col("_end.count").alias("_count"),
            "_head",
            (F.col("_end._start") == 1).alias("_single"),
        )
    )
    if prior is not None:
        hot = pieces.select(*keys).distinct()
        before = _from_state(prior, keys, _BEFORE).join(hot, keys, "left_semi")
        pieces = pieces.unionByName(
            before.withColumns({"_head": F.col("_last"), "_single": F.lit(True)})
        )

    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    joined = _near(F.lag("_last").over(by_piece), F.col("_head"), tol)
    goes_on = F.col("_single") & F.coalesce(joined, F.lit(False))
    chain = F.sum((~F.col("_goes_on")).cast("int")).over(_so_far(by_piece))
    by_chain = Window.partitionBy(*keys, "_chain").orderBy("_piece")
    return (
        pieces.withColumn("_goes_on", goes_on)
        .withColumn("_chain", chain)
        .withColumn("_count", F.sum("_count").over(_so_far(by_chain)))
        .select(
            *keys,
            "_piece",
            F.lag("_last").over(by_piece).alias("_last"),
            F.lag("_count").over(by_piece).alias("_count"),
        )
        .filter(F.col("_count").isNotNull())
    )


def stuck_runs(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    value_col: str,
    threshold: int = STUCK_THRESHOLD,
    tol: float = STUCK_TOLERANCE,
    *,
    prior: DataFrame | None = None,
    rows_per_piece: int | None = ROWS_PER_PIECE,
    dealt: bool = False,
) -> DataFrame:
    """Add ``run_length`` (position in the run) and ``is_stuck``.

    ``order_cols`` starts with the event time. Rows without key or value pass
    through unflagged and do not interrupt a run. ``prior`` is a state snapshot
    (keys, ``last_value``, ``repeat_count``) of what was processed before.
    ``rows_per_piece=None`` promises that no key is large and skips the count; with
    ``dealt`` rows lie by ``keys`` already, and meet ``prior`` without moving again.
    """
    keys, order_cols = list(keys), list(order_cols)
    idle = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*keys, value_col]])
    spread = F.pmod(F.xxhash64(*order_cols), F.lit(IDLE_GROUPS))
    if rows_per_piece is None:
        frame, piece = df, F.lit(_WHOLE)
    else:
        live = df.filter(~idle).select(*keys, order_cols[0])
        slots = hot_slots(live, keys, order_cols[0], rows_per_piece)
        frame = df.join(_sent(slots, rows_per_piece), keys, "left")
        slot = F.floor(_minute(F.col(order_cols[0])) / F.col("_width"))
        piece = F.coalesce(slot, F.lit(_WHOLE))
    frame = frame.withColumns({"_idle": idle, "_piece": F.when(idle, spread).otherwise(piece)})
    if rows_per_piece is not None:
        # Where the slots came by a shuffle of the keys, a key's pieces would stay in one task.
        frame = frame.repartition(*keys, "_idle", "_piece")

    in_order = Window.partitionBy(*keys, "_idle", "_piece").orderBy(*order_cols)
    changed = F.coalesce(~_near(F.col("_prev"), F.col(value_col), tol), F.lit(True))
    measured = frame.withColumns(
        {
            "_prev": F.lag(value_col).over(in_order),
            "_rn": F.row_number().over(in_order).cast("bigint"),
            "_head": F.first(value_col).over(_so_far(in_order)),
        }
    ).withColumn("_start", F.max(F.when(changed, F.col("_rn"))).over(_so_far(in_order)))

    carried = []
    if rows_per_piece is not None:
        carried.append(_handed_over(measured, keys, order_cols, value_col, tol, prior))
    if prior is not None:
        carried.append(_from_state(prior, keys, _WHOLE))
    run = _run()
    if carried:
        before = reduce(DataFrame.unionByName, carried).withColumn("_idle", F.lit(False))
        if dealt and rows_per_piece is None:  # idle rows meet a state as well, but have no run
            measured = measured.join(before.drop("_idle", "_piece"), keys, "left")
        else:
            measured = measured.join(before, [*keys, "_idle", "_piece"], "left")
        goes_on = (F.col("_start") == 1) & _near(F.col("_last"), F.col("_head"), tol)
        run = run + F.when(goes_on, F.col("_count")).otherwise(0)
    moving = F.abs(F.col(value_col)) > tol
    stuck = F.coalesce((F.col("run_length") >= threshold) & moving, F.lit(False))
    return measured.select(
        *df.columns, F.when(~F.col("_idle"), run).alias("run_length")
    ).withColumn("is_stuck", stuck)


def state_after(
    flagged: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    value_col: str,
    prior: DataFrame | None = None,
) -> DataFrame:
    """State snapshot after ``flagged`` rows: one row per key, flagged rows included.

    Keys that only ``prior`` knows keep their state.
    """
    last = F.struct(F.col(value_col).alias("last_value"), F.col("run_length").alias("repeat_count"))
    fresh = (
        flagged.filter(F.col("run_length").isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(last, F.struct(*order_cols)).alias("_s"))
        .select(*keys, "_s.last_value", "_s.repeat_count")
    )
    if prior is None:
        return fresh
    newest = F.max_by(F.struct("last_value", "repeat_count"), "_gen").alias("_s")
    old = prior.select(*keys, "last_value", "repeat_count", F.lit(0).alias("_gen"))
    return (
        fresh.withColumn("_gen", F.lit(1))
        .unionByName(old)
        .groupBy(*keys)
        .agg(newest)
        .select(*keys, "_s.last_value", "_s.repeat_count")
    )

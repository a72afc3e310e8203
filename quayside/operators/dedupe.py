"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep the first row of each key by ``order_cols``.

    An aggregate rather than a ranking window: copies collapse before the
    shuffle, so a key holding a third of all rows sends one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_first")
    return df.groupBy(*keys).agg(first).selectExpr(
        *[f"`{c}`" if c in keys else f"_first.`{c}`" for c in df.columns]
    )


def first_of_sorted(
    df: DataFrame, keys: Sequence[str], ts_col: str, order_cols: Sequence[str]
) -> DataFrame:
    """``dedupe_first`` by ``keys`` and ``ts_col``, where no one of ``keys`` is large.

    Rows are dealt by ``keys`` and sorted once, which windows over the same keys use again.
    """
    at = Window.partitionBy(*keys).orderBy(ts_col, *order_cols)
    seen = df.withColumns({"_row": F.row_number().over(at), "_ts": F.lag(ts_col).over(at)})
    first = (F.col("_row") == 1) | ~F.col("_ts").eqNullSafe(F.col(ts_col))
    return seen.filter(first).select(*df.columns)

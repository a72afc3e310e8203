"""Rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.time import PUBLISH_FORMAT


def to_keyed_json(
    df: DataFrame, key: str = "equipment_id", drop: tuple[str, ...] = ("day_bucket",)
) -> DataFrame:
    """``key`` and ``value`` columns; rows without an id are not published."""
    columns = [c for c in df.columns if c not in drop]
    return df.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*columns), {"timestampFormat": PUBLISH_FORMAT}).alias("value"),
    )

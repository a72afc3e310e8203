"""Stored state of the stuck-value runs: a row per equipment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.catalogue import struct_of
from quayside.sinks.keyed import EVERY, KeyedLog

STATE_KEYS = ("equipment_type", "equipment_id")
STATE_SCHEMA = struct_of(
    "equipment_type STRING, equipment_id STRING, last_value DOUBLE, repeat_count BIGINT, "
    "updated_at TIMESTAMP"
)


class StuckState(KeyedLog):
    """The state below one folder; batches are its versions."""

    def __init__(self, path: str, every: int = EVERY):
        super().__init__(path, STATE_KEYS, STATE_SCHEMA, every)

    def write(self, state: DataFrame, version: int) -> None:
        count = F.col("repeat_count").cast("bigint").alias("repeat_count")
        now = F.current_timestamp().alias("updated_at")
        super().write(state.select(*STATE_KEYS, "last_value", count, now), version)

"""Event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.catalogue import Kind, resolve, struct_of
from quayside.functions import time
from quayside.plans.warehouse import fact_aggregates
from quayside.sinks.keyed import KeyedLog

HOUR_KEYS = ("equipment_id", "date_key", "hour_key")


def stream_hourly(
    clean: DataFrame, kind: str | Kind, delay: str = "1 hour", ts_col: str = "event_timestamp"
) -> DataFrame:
    """Hourly aggregates per equipment id, each emitted once its hour is complete.

    An hour is complete when readings ``delay`` after its end have been seen;
    rows that come later are not counted here but in ``hourly_backfill``.
    """
    k = resolve(kind)
    start = F.col("hour.start")
    aggregates = fact_aggregates(k)
    return (
        clean.withWatermark(ts_col, delay)
        .groupBy(F.window(ts_col, "1 hour").alias("hour"), "equipment_id")
        .agg(*aggregates)
        .withColumns({"date_key": time.date_key(start), "hour_key": time.hour_key(start)})
        .drop("hour")
    )


def hourly_schema(kind: str | Kind) -> T.StructType:
    k = resolve(kind)
    doubles = [f"{f}_{m}" for m in k.measures for f in ("avg", "min", "max")]
    if k.counter is not None:
        doubles.append(f"max_{k.counter}")
    counts = ["measurement_count BIGINT", f"{k.incident.count_name} BIGINT"]
    values = [*counts, *[f"{c} DOUBLE" for c in doubles], "last_reading TIMESTAMP"]
    return struct_of(", ".join(["equipment_id STRING, date_key INT, hour_key INT", *values]))


def hourly_log(path: str, kind: str | Kind) -> KeyedLog:
    return KeyedLog(path, HOUR_KEYS, hourly_schema(kind))


def start_hourly_stream(
    clean: DataFrame,
    kind: str | Kind,
    path: str,
    checkpoint: str,
    delay: str = "1 hour",
    ts_col: str = "event_timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep hourly aggregates below ``path`` while their hours are still open.

    A micro-batch writes the hours it changed, and no others, as a version of their rows;
    one that is repeated replaces its own. So an hour can be read from its first reading
    on (``hourly_now``), and its row is replaced until readings ``delay`` after its end
    have been seen. Later rows are left to ``load_changed_hours``.
    """
    k = resolve(kind)
    start, log = F.col("hour.start"), hourly_log(path, k)
    hours = (
        clean.withWatermark(ts_col, delay)
        .groupBy(F.window(ts_col, "1 hour").alias("hour"), "equipment_id")
        .agg(*fact_aggregates(k), F.max(ts_col).alias("last_reading"))
        .withColumns({"date_key": time.date_key(start), "hour_key": time.hour_key(start)})
        .select(*log.schema.names)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            log.write(batch, batch_id)
            log.forget(batch.sparkSession, batch_id)

    return (
        hours.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def hourly_now(
    spark: SparkSession, path: str, kind: str | Kind, delay: str = "1 hour"
) -> DataFrame | None:
    """All hours so far, with ``provisional``: readings may still be added to this one."""
    rows = hourly_log(path, kind).before(spark)
    if rows is None:
        return None
    seen = rows.agg(F.max("last_reading")).first()[0]
    end = F.make_timestamp(
        F.floor(F.col("date_key") / 10000).cast("int"),
        F.floor(F.col("date_key") / 100).cast("int") % 100,
        F.col("date_key") % 100,
        F.col("hour_key"),
        F.lit(0),
        F.lit(0),
    ) + F.expr("INTERVAL 1 HOUR")
    still = end > F.lit(seen) - F.expr(f"INTERVAL {delay}")
    return rows.withColumn("provisional", still).drop("last_reading")

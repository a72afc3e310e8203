"""Facts kept up to date by what has changed: hours that late or repeated batches touch.

A ledger remembers, of each batch folder, when it was written and which hours of which kind
it holds. A run looks for folders that the ledger does not know, or knows from an earlier
writing, and reads these alone to learn the hours they touch; hours that a batch held before
it was written again count as well. Just those hours are then loaded from the clean table,
the complete ones, and the rest wait in the ledger for a later run. Days without a touched
hour are not read. Runs follow one another; a run that was lost is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.catalogue import KINDS, Kind, struct_of
from quayside.functions import time
from quayside.plans import warehouse
from quayside.plans.etl import Tables, add_missing, stamped
from quayside.session import stage
from quayside.sinks import batches, tables
from quayside.sinks.keyed import DELTA, KeyedLog

BATCH = ["source", "writer", "batch_id"]
LEDGER = struct_of(
    "source STRING, writer STRING, batch_id BIGINT, equipment_type STRING, hour TIMESTAMP, "
    "written_at BIGINT, loaded BOOLEAN"
)
CLEAN, REJECTED = "clean", "rejected"


def ledger(stored: Tables) -> KeyedLog:
    return KeyedLog(stored.path("load_ledger"), [*BATCH, "equipment_type", "hour"], LEDGER)


def _hour(ts: str) -> Column:
    return F.date_trunc("hour", F.col(ts))


def changed_batches(
    spark: SparkSession, path: str, source: str, known: DataFrame | None
) -> list[tuple[batches.Folder, int]]:
    """Folders written since the ledger saw them, with the time; names and times alone are compared."""
    seen: set[tuple] = set()
    if known is not None:
        of_source = known.filter(F.col("source") == source)
        rows = of_source.groupBy("writer", "batch_id").agg(F.max("written_at").alias("at")).collect()
        seen = {(r.writer, r.batch_id, r["at"]) for r in rows}  # one per batch folder
    found = [(f, batches.written_at(spark, f.path)) for f in batches.current(spark, path)]
    return [(f, at) for f, at in found if (f.folder_writer, f.last, at) not in seen]


def touched_hours(
    spark: SparkSession, stored: Tables, source: str, known: DataFrame | None, kinds: Sequence[Kind]
) -> DataFrame | None:
    """Ledger rows, not loaded yet, of the batches of ``source`` that changed."""
    path, schema, ts = {
        CLEAN: (stored.clean, tables.clean_schema(kinds), "event_timestamp"),
        REJECTED: (stored.rejected, tables.REJECTED_SCHEMA, "rejected_at"),
    }[source]
    changed = changed_batches(spark, path, source, known)
    if not changed:
        return None
    times = spark.createDataFrame(
        [(f.folder_writer, f.last, at) for f, at in changed], "writer string, batch_id bigint, written_at bigint"
    )
    kind = F.col("equipment_type") if source == CLEAN else F.lit(None).cast("string")
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f.path for f, _ in changed])
    held = rows.select("writer", "batch_id", kind.alias("equipment_type"), _hour(ts).alias("hour"))
    empty = times.select("writer", "batch_id", F.lit(None).alias("equipment_type"), F.lit(None).alias("hour"))
    found = held.distinct().union(empty)  # a batch without rows is known as well
    if known is not None:
        before = known.filter(F.col("source") == source)
        found = found.union(before.select(*found.columns).join(times, ["writer", "batch_id"], "left_semi")).distinct()
    return found.join(F.broadcast(times), ["writer", "batch_id"]).select(
        F.lit(source).alias("source"), "writer", "batch_id", "equipment_type", "hour", "written_at", F.lit(False).alias("loaded")
    )


def load_changed_hours(
    spark: SparkSession, stored: Tables, as_of: datetime, kinds: Sequence[Kind] = KINDS
) -> DataFrame:
    """The scheduled job: every hour, complete before ``as_of``, that batches have touched since.

    Returns the hours loaded: ``source, equipment_type, hour``. Batches that were merged
    since the last run are one new folder, whose hours are loaded once more.
    """
    log = ledger(stored)
    known = log.before(spark)
    open_rows = [touched_hours(spark, stored, source, known, kinds) for source in (CLEAN, REJECTED)]
    if known is not None:
        open_rows.append(known.filter("NOT loaded AND hour IS NOT NULL"))
    open_rows = [rows for rows in open_rows if rows is not None]
    if not open_rows:
        return spark.createDataFrame([], "source string, equipment_type string, hour timestamp")
    every = open_rows[0]
    for rows in open_rows[1:]:
        every = every.unionByName(rows)
    # a batch that changed while hours of it were waiting is there twice
    newest = F.max("written_at").alias("written_at")
    every = every.groupBy(*log.keys).agg(newest, F.lit(False).alias("loaded"))
    every = stage(every, "touched-hours")
    complete = F.coalesce(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= time.timestamp_literal(as_of), F.lit(True))
    ready = every.filter(complete)
    hours = stage(ready.filter("hour IS NOT NULL").select("source", "equipment_type", "hour").distinct(), "ready-hours")
    _load_clean(spark, stored, hours.filter(F.col("source") == CLEAN), kinds)
    _load_rejected(spark, stored, hours.filter(F.col("source") == REJECTED))
    rows = every.withColumn("loaded", complete)
    log.write(rows, max(log.versions(spark, DELTA), default=-1) + 1)
    return hours


def _in_hours(rows: DataFrame, hours: DataFrame, ts: str, day: str, days: list) -> DataFrame:
    """Rows of the hours: their days prune partitions, the join does the rest."""
    wanted = hours.select(F.col("hour").alias("_hour"))
    return rows.filter(F.col(day).isin(days)).join(wanted, _hour(ts) == F.col("_hour"), "left_semi")


def _days(hours: DataFrame) -> list:
    return [r.day for r in hours.select(F.to_date("hour").alias("day")).distinct().collect()]  # a value per day


def _load_clean(spark: SparkSession, stored: Tables, hours: DataFrame, kinds: Sequence[Kind]) -> None:
    per_kind = {k.name: hours.filter(F.col("equipment_type") == k.name).select("hour") for k in kinds}
    days = {name: _days(own) for name, own in per_kind.items()}
    touched = [k for k in kinds if days[k.name]]
    if not touched:
        return
    add_missing(warehouse.build_dim_hour(spark), stored.path("dim_hour"), "hour_key")
    calendar = hours.select(F.to_date("hour").alias("day"))
    add_missing(warehouse.dim_date_rows(calendar, "day"), stored.path("dim_date"), "date_key")
    clean = tables.open_clean(spark, stored.clean, kinds)
    window = {
        k.name: _in_hours(tables.clean_of_kind(clean, k), per_kind[k.name], "event_timestamp", "event_date", days[k.name])
        for k in touched
    }
    dim_path = stored.path("dim_equipment")
    existing = tables.read_if_exists(spark, dim_path)
    tables.append(warehouse.build_dim_equipment(window, existing, touched), dim_path)
    dim = spark.read.parquet(dim_path)
    for kind in touched:
        by_id = warehouse.hourly_by_id(window[kind.name], kind)
        fact = warehouse.with_equipment_key(by_id, dim)
        whole = warehouse.with_date_hour_keys(per_kind[kind.name], "hour")
        tables.upsert_fact(stamped(fact), stored.fact(kind), whole=whole)


def _load_rejected(spark: SparkSession, stored: Tables, hours: DataFrame) -> None:
    days = _days(hours)
    if not days:
        return
    rejected = tables.read_rejected(spark, stored.rejected)
    rows = _in_hours(rejected, hours.select("hour"), "rejected_at", "rejected_date", days)
    whole = warehouse.with_date_hour_keys(hours.select("hour"), "hour")
    tables.upsert_fact(stamped(warehouse.rejections(rows)), stored.rejected_fact, whole=whole)

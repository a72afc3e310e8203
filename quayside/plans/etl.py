"""Jobs over stored tables: cleaning a batch into them, loading the warehouse, opening it.

Every job can be repeated: a batch and an hour replace themselves, dimensions
only gain keys that they lack.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.catalogue import KINDS, STUCK_THRESHOLD, Kind
from quayside.functions import time
from quayside.operators.merge import insert_if_absent
from quayside.operators.publish import to_keyed_json
from quayside.operators.quality import split_valid, to_rejected_mixed
from quayside.plans import warehouse
from quayside.plans.cleaning import clean_validated, next_state, validate_messages
from quayside.plans.serving import Monitor
from quayside.session import stage
from quayside.sinks import batches, tables
from quayside.sinks.external import publish
from quayside.sinks.state import StuckState
from quayside.sources import raw

WRITE_ORDER = "write_order"
UNKNOWN_TYPE = "type_inconnu"


@dataclass(frozen=True)
class Tables:
    """Where the tables live, below one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def clean(self) -> str:
        return self.path("clean")

    @property
    def rejected(self) -> str:
        return self.path("rejected_data")

    @property
    def raw(self) -> str:
        return self.path("raw")

    @property
    def rejected_import(self) -> str:
        return self.path("rejected_import")

    @property
    def rejected_fact(self) -> str:
        return self.path("fact_rejected_hourly")

    def fact(self, kind: Kind) -> str:
        return self.path(f"fact_{kind.name}_hourly")


def clean_to_tables(
    messages: DataFrame,
    stored: Tables,
    batch_id: int,
    kinds: Sequence[Kind] = KINDS,
    threshold: int = STUCK_THRESHOLD,
) -> None:
    """Batch twin of the cleaning stream: messages into the clean and rejected tables.

    A load that is repeated under its ``batch_id`` replaces itself; every other load
    needs a number of its own. Streams into the same tables have their own folders.

    Stuck runs go on from load to load, by ascending number: a load starts from the state
    that lower numbers left. States of all loads are kept, so any load can be repeated.
    """
    spark, state = messages.sparkSession, StuckState(stored.path("stuck_state"))
    validated = stage(validate_messages(messages, kinds), "validated")
    valid, _ = split_valid(validated)
    prior = state.before(spark, batch_id, only=valid)
    outcome = stage(clean_validated(validated, kinds, threshold, prior=prior), "outcome")
    clean, rejected = split_valid(outcome)
    rows = tables.clean_rows(clean, kinds)
    tables.write_clean(rows, stored.clean, batch_id)
    tables.write_ids(rows, stored.clean, batch_id)
    tables.write_rejected(to_rejected_mixed(rejected, kinds), stored.rejected, batch_id)
    state.write(next_state(outcome), batch_id)


def loaded_state(spark: SparkSession, stored: Tables) -> DataFrame | None:
    """The stuck state that all loads so far left, for a stream to begin from."""
    return StuckState(stored.path("stuck_state")).before(spark)


def merge_batches(
    spark: SparkSession,
    stored: Tables,
    before: int,
    writer: str = "batch",
    kinds: Sequence[Kind] = KINDS,
) -> None:
    """Fewer files: merge the batches below ``before`` of one writer, in both tables.

    Readers see each row once all the while. The batches stay until ``drop_merged``.
    ``kinds`` are all kinds that the clean table holds.
    """
    for path, schema, partitions in (
        (stored.clean, tables.clean_schema(kinds), tables.CLEAN_PARTITIONS),
        (stored.rejected, tables.REJECTED_SCHEMA, tables.REJECTED_PARTITIONS),
    ):
        batches.merge(spark, path, schema, partitions, before, writer)


def drop_merged(spark: SparkSession, stored: Tables) -> None:
    """Delete the batches that merges replaced, once queries opened before have ended."""
    for path in (stored.clean, stored.rejected):
        batches.drop_merged(spark, path)


def ingest_files(
    spark: SparkSession,
    path: str | list[str],
    stored: Tables,
    load_id: int,
    as_of: datetime,
    kinds: Sequence[Kind] = KINDS,
) -> None:
    """Exported sheets into the raw table; each sheet is read by its own header.

    Rows of unknown type and unreadable time go to ``rejected_import``, with the reason
    and all their cells. Of equal keys the later row wins, and the higher ``load_id``.
    """
    sheet = raw.drop_blank_rows(raw.import_folder(spark, path))
    order = F.struct(
        F.lit(load_id).cast("bigint").alias("load"), F.monotonically_increasing_id().alias("row")
    )
    known, unknown = raw.route_by_type(stage(sheet.withColumn(WRITE_ORDER, order), "sheet"), kinds)
    rows, unreadable = raw.prepare_import(known, as_of)
    rows = raw.textify(rows, keep=("timestamp", WRITE_ORDER))
    tables.upsert_raw_table(rows, stored.raw, WRITE_ORDER)
    cells = F.to_json(F.struct(*sheet.columns)).alias("source_json")
    unknown = unknown.select(cells, F.lit(UNKNOWN_TYPE).alias("reject_reason"))
    rejected = unknown.unionByName(unreadable.select(cells, "reject_reason"))
    rejected.write.mode("overwrite").parquet(f"{stored.rejected_import}/load_id={load_id}")


def raw_messages(
    spark: SparkSession, stored: Tables, kinds: Sequence[Kind] = KINDS
) -> DataFrame:
    """``topic, key, value`` for every row of the raw table, typed by the catalogue."""
    return reduce(
        DataFrame.unionByName,
        [
            to_keyed_json(raw.infer_type(raw.scan_raw(spark, stored.raw, k), k)).select(
                F.lit(k.topic).alias("topic"), "key", "value"
            )
            for k in kinds
        ],
    )


def publish_raw(
    spark: SparkSession, stored: Tables, servers: str, kinds: Sequence[Kind] = KINDS
) -> None:
    """Send the raw table to the kinds' topics."""
    for kind in kinds:
        messages = raw_messages(spark, stored, [kind])
        publish(messages.select("key", "value"), servers, kind.topic)


def add_missing(new: DataFrame, path: str, key: str) -> None:
    existing = tables.read_if_exists(new.sparkSession, path)
    tables.append(new if existing is None else insert_if_absent(new, existing, [key]), path)


def load_hours(
    spark: SparkSession,
    stored: Tables,
    first_hour: datetime,
    last_hour: datetime,
    kinds: Sequence[Kind] = KINDS,
) -> None:
    """Dimensions and facts of every hour from ``first_hour`` to ``last_hour``, included.

    Late rows and skipped hours are loaded by naming their hours again.
    """
    end = last_hour + warehouse.HOUR
    add_missing(warehouse.build_dim_hour(spark), stored.path("dim_hour"), "hour_key")
    days = warehouse.build_dim_date(spark, first_hour.date(), last_hour.date())
    add_missing(days, stored.path("dim_date"), "date_key")

    clean = tables.open_clean(spark, stored.clean, kinds)
    window = {
        k.name: warehouse.hour_window(
            tables.clean_of_kind(clean, k), "event_timestamp", first_hour, end
        )
        for k in kinds
    }
    dim_path = stored.path("dim_equipment")
    existing = tables.read_if_exists(spark, dim_path)
    tables.append(warehouse.build_dim_equipment(window, existing, kinds), dim_path)
    dim = spark.read.parquet(dim_path)

    for kind in kinds:
        by_id = warehouse.hourly_by_id(window[kind.name], kind)
        fact = warehouse.with_equipment_key(by_id, dim)
        tables.upsert_fact(stamped(fact), stored.fact(kind), hours=(first_hour, last_hour))
    rejected = tables.read_rejected(spark, stored.rejected)
    counted = warehouse.rejected_hourly(rejected, first_hour, end)
    tables.upsert_fact(stamped(counted), stored.rejected_fact, hours=(first_hour, last_hour))


def load_last_hour(
    spark: SparkSession, stored: Tables, as_of: datetime, kinds: Sequence[Kind] = KINDS
) -> None:
    """The scheduled job: the last complete hour before ``as_of``, for all tables."""
    hour = time.target_hour(as_of)
    load_hours(spark, stored, hour, hour, kinds)


def stamped(fact: DataFrame) -> DataFrame:
    return fact.withColumn("processed_at", F.current_timestamp())


def open_monitor(
    spark: SparkSession, stored: Tables, kinds: Sequence[Kind] = KINDS
) -> Monitor:
    """The monitoring queries over the stored tables."""
    clean = tables.open_clean(spark, stored.clean, kinds)
    return Monitor(
        clean=lambda k: tables.clean_of_kind(clean, k),
        fact=lambda k: tables.read_fact(spark, stored.fact(k), k),
        dim_equipment=spark.read.parquet(stored.path("dim_equipment")),
        rejected=tables.read_rejected(spark, stored.rejected),
        fact_rejected=tables.read_rejected_fact(spark, stored.rejected_fact),
        raw=lambda k: raw.scan_raw(spark, stored.raw, k),
        kinds=tuple(kinds),
        stored=True,
    )

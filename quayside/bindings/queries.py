"""The registered queries: every operator, run over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.bindings.frames import (
    AS_OF,
    EVENT_KINDS,
    READING,
    SHIPMENT,
    levels,
    raw_rows,
    readings,
    shipments,
    supplier_dim,
    table,
    telemetry,
    telemetry_of,
)
from quayside.bindings.replay import BORDERS, replay, slices
from quayside.catalogue import KINDS, Kind
from quayside.functions import text, time
from quayside.functions.time import timestamp_literal
from quayside.operators import counts, merge, quality
from quayside.operators.dedupe import dedupe_first
from quayside.operators.publish import to_keyed_json
from quayside.operators.stuck import state_after, stuck_runs
from quayside.plans import serving, warehouse
from quayside.plans.cleaning import clean_batch
from quayside.plans.etl import (
    Tables,
    clean_to_tables,
    drop_merged,
    ingest_files,
    load_hours,
    loaded_state,
    merge_batches,
    raw_messages,
)
from quayside.session import configure, stage, workspace
from quayside.sinks import tables
from quayside.sinks.clustered import write_clustered
from quayside.sources import raw
from quayside.sources.topics import parse_payload, stream_source
from quayside.streaming.clean import batch_counts as counts_of_batches
from quayside.streaming.clean import start_clean_stream
from quayside.plans.maintenance import load_changed_hours
from quayside.streaming.ingest import start_ingest_stream
from quayside.streaming.ordered import admit, rocksdb, stuck_stream_ordered
from quayside.streaming.state import dedupe_stream, stuck_stream
from quayside.streaming.windows import hourly_now, start_hourly_stream, stream_hourly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_HOUR, LAST_HOUR = datetime(2024, 1, 1), datetime(2024, 1, 31)
CUT = datetime(2024, 1, 15)
LATER = 10**12
MANY = 1200
HISTORY_DAYS = ("2024-01-05", "2024-01-06", "2024-01-20")
LEVEL_KEYS, LEVEL_ORDER = ["equipment_id"], ["event_timestamp", "seq"]


def query(name: str | Query) -> Query:
    """Register a query, under its function's name unless one is given.

    Results come zone-less and rounded, as the comparison needs them.
    """
    if callable(name):
        return query(name.__name__)(name)

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(configure(spark), sf_dir))

        QUERIES[name] = run
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    def plain(name: str, data_type: str) -> Column:
        if data_type == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if data_type == "double":
            return F.round(name, 6).alias(name)
        return F.col(name)

    return df.select(*[plain(*column) for column in df.dtypes])


# --- readings: validation and projections -------------------------------------------


def checked(spark: SparkSession, sf_dir: str, **rules) -> DataFrame:
    return quality.with_reject_reason(readings(spark, sf_dir), READING, **rules)


def valid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.split_valid(checked(spark, sf_dir))
    return quality.to_clean_columns(valid, READING, extra=["seq", "topic"])


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected readings, one topic per event type, filed ninety seconds after arrival."""
    _, rejected = quality.split_valid(checked(spark, sf_dir))
    at = F.col("arrived_at") + F.expr("INTERVAL 90 SECONDS")
    return quality.to_rejected(rejected, READING, at)


def rejected_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.split_valid(checked(spark, sf_dir))
    return rejected.withColumn("rejected_at", F.col("arrived_at") + F.expr("INTERVAL 90 SECONDS"))


@query
def reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir).select(
        "seq", "equipment_id", "event_timestamp", "state", "alarm", "reject_reason"
    )


@query
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_readings(spark, sf_dir)


@query
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(spark, sf_dir).drop("source_json")


@query
def state_domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = ("CLICK", "PURCHASE", "VIEW")
    return checked(spark, sf_dir, state_domain=domain).select("seq", "state", "reject_reason")


@query
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(checked(spark, sf_dir), READING).select("seq", "rule", "field")


@query
def violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = quality.violations(checked(spark, sf_dir), READING)
    return long.groupBy("topic", "rule", "field").agg(F.count("*").alias("row_count"))


@query
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("seq", F.col("timestamp").alias("message_time"))
    spaced = F.replace(F.col("message_time"), F.lit("T"), F.lit(" "))
    rows = rows.withColumn("import_time", F.substring(spaced, 1, 19))
    rows = raw.parse_timestamp(rows, "message_time")
    return raw.parse_timestamp(rows, "import_time", time.IMPORT_FORMAT)


@query
def day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("seq", time.event_time(F.col("timestamp")).alias("timestamp"))
    return raw.with_day_bucket(rows, AS_OF)


@query
def date_hour_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("seq", "arrived_at")
    return warehouse.with_date_hour_keys(rows, "arrived_at").drop("arrived_at")


@query
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("p_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", padded, "p_brand", "p_type")
    return quality.normalize_text(parts, ["p_name", "p_brand"])


@query
def textify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = levels(spark, sf_dir).select(
        "seq",
        F.col("event_timestamp").alias("timestamp"),
        "equipment_id",
        (F.col("seq") % 1000).alias("load"),
        "level",
        (F.col("level") > 1).alias("container_attached"),
    )
    return raw.textify(rows, keep=("seq", "timestamp"))


def loose_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every sort: flags, whole numbers, decimals, words, nothing."""
    nth = F.col("event_id") % 7
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.when(nth == 0, "true")
        .when(nth == 1, " FALSE ")
        .when(nth == 2, F.col("user_id").cast("string"))
        .when(nth == 3, F.col("value").cast("string"))
        .when(nth == 4, F.col("event_type"))
        .when(nth == 5, F.concat(F.col("user_id").cast("string"), F.lit("f")))
        .alias("cell"),
    )


@query
def infer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("cell")
    return loose_text(spark, sf_dir).select(
        "seq", text.loose_type(cell).alias("loose_type"), text.loose_json(cell).alias("loose_json")
    )


@query
def infer_type_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, to all text, and back to the catalogue's types."""
    rows = readings(spark, sf_dir).select("seq", *READING.fields)
    return raw.infer_type(raw.textify(rows, keep=("seq",)), READING)


@query("to_keyed_json")
def to_keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = levels(spark, sf_dir).select(
        F.when(F.col("seq") % 89 != 0, F.col("equipment_id")).alias("equipment_id"),
        "seq",
        "level",
        F.when(F.col("seq") % 7 != 0, F.lit("NONE")).alias("alarm"),
        F.lit("2024-01-01").alias("day_bucket"),
    )
    return to_keyed_json(rows)


# --- telemetry: messages of the six kinds ----------------------------------------------


def checked_messages(spark: SparkSession, sf_dir: str, kind: Kind) -> DataFrame:
    parsed = parse_payload(telemetry_of(spark, sf_dir, kind), kind)
    return quality.with_reject_reason(parsed, kind)


def clean_of(spark: SparkSession, sf_dir: str, kind: Kind) -> DataFrame:
    valid, _ = quality.split_valid(checked_messages(spark, sf_dir, kind))
    clean = quality.to_clean_columns(valid, kind, extra=["offset"])
    return dedupe_first(clean, ["equipment_id", "event_timestamp"], ["offset"])


def by_kind(prefix: str, build: Callable[[SparkSession, str, Kind], DataFrame]) -> None:
    for kind in KINDS:

        def run(spark: SparkSession, sf_dir: str, kind: Kind = kind) -> DataFrame:
            return build(spark, sf_dir, kind)

        query(f"{prefix}_{kind.name}")(run)


def _parse(spark: SparkSession, sf_dir: str, kind: Kind) -> DataFrame:
    parsed = parse_payload(telemetry_of(spark, sf_dir, kind), kind)
    return parsed.drop("topic", "key", "arrived_at", "source_json")


def _reason(spark: SparkSession, sf_dir: str, kind: Kind) -> DataFrame:
    return checked_messages(spark, sf_dir, kind).select(
        "offset", "equipment_id", "event_timestamp", *kind.text_fields, "reject_reason"
    )


def _fact(spark: SparkSession, sf_dir: str, kind: Kind) -> DataFrame:
    clean = stage(clean_of(spark, sf_dir, kind), "clean")
    dim = warehouse.build_dim_equipment({kind.name: clean})
    return warehouse.hourly_backfill(clean, dim, kind, FIRST_HOUR, LAST_HOUR)


by_kind("parse_payload", _parse)
by_kind("reject_reason", _reason)
by_kind("clean_rows", clean_of)
by_kind("hourly_fact", _fact)


def verdicts(outcome: DataFrame) -> DataFrame:
    return outcome.select("topic", "equipment_id", "event_timestamp", "reject_reason")


@query
def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning over all six kinds: one row per message kept, with its verdict."""
    return verdicts(clean_batch(telemetry(spark, sf_dir)))


@query
def stuck_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = clean_batch(telemetry(spark, sf_dir))
    return outcome.filter(F.col("reject_reason") == "capteur_bloque").select(
        "topic", "equipment_id", "event_timestamp", "watched", "run_length"
    )


@query
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.batch_counts(clean_batch(telemetry(spark, sf_dir)))


@query
def reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.reject_rate(clean_batch(telemetry(spark, sf_dir)))


@query
def topic_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.topic_profile(telemetry(spark, sf_dir), key="key")


@query
def payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that a tenth of the messages have beyond the catalogue."""
    added = F.concat(
        F.regexp_extract("value", r"^(.*)\}$", 1),
        F.lit(',"firmware":"1.2","retries":'),
        F.when(F.col("offset") % 20 == 0, "3").otherwise("null"),
        F.lit(',"nested":{"a":1.5}}'),
    )
    more = (F.col("offset") % 10 == 0) & F.col("value").endswith("}")
    messages = telemetry(spark, sf_dir)
    return counts.unknown_fields(messages.withColumn("value", F.when(more, added).otherwise(F.col("value"))))


@query
def union_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rejects and stuck rows of each kind, one side lacking ``run_length``."""

    def of_kind(kind: Kind) -> DataFrame:
        valid, rejected = quality.split_valid(checked_messages(spark, sf_dir, kind))
        survivors = dedupe_first(valid, ["equipment_id", "event_timestamp"], ["offset"])
        order = ["event_timestamp", "offset"]
        runs = stuck_runs(survivors, ["equipment_id"], order, kind.watched)
        stuck = runs.filter("is_stuck").withColumn("reject_reason", F.lit("capteur_bloque"))
        return quality.union_rejects(rejected, stuck).select(
            F.lit(kind.name).alias("equipment_type"),
            "offset",
            "equipment_id",
            "reject_reason",
            "run_length",
        )

    return reduce(DataFrame.unionByName, map(of_kind, KINDS))


# --- sequences and keys ----------------------------------------------------------------


def level_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuck_runs(levels(spark, sf_dir), LEVEL_KEYS, LEVEL_ORDER, "level")


@query("stuck_runs")
def stuck_runs_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_runs(spark, sf_dir).select("seq", "level", "run_length", "is_stuck")


@query
def stuck_runs_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every key cut into pieces, as a hot key would be."""
    runs = stuck_runs(levels(spark, sf_dir), LEVEL_KEYS, LEVEL_ORDER, "level", rows_per_piece=20)
    return runs.select("seq", "level", "run_length", "is_stuck")


def clustered_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "levels")
    name = f"levels_{path.rsplit('-', 1)[1]}"
    return write_clustered(levels(spark, sf_dir), name, path, LEVEL_KEYS, LEVEL_ORDER, buckets=8)


@query
def stuck_runs_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a table that is stored by key: nothing is shuffled."""
    rows = clustered_levels(spark, sf_dir)
    runs = stuck_runs(rows, LEVEL_KEYS, LEVEL_ORDER, "level", rows_per_piece=None)
    return runs.select("seq", "level", "run_length", "is_stuck")


@query
def state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second half of the readings, started from the state the first half left."""
    before, after = slices(levels(spark, sf_dir), "event_timestamp", [CUT])
    first = stuck_runs(before, LEVEL_KEYS, LEVEL_ORDER, "level")
    state = state_after(first, LEVEL_KEYS, LEVEL_ORDER, "level")
    runs = stuck_runs(after, LEVEL_KEYS, LEVEL_ORDER, "level", prior=state)
    return runs.select("seq", "level", "run_length", "is_stuck")


@query
def stuck_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_after(level_runs(spark, sf_dir), LEVEL_KEYS, LEVEL_ORDER, "level")


@query("dedupe_first")
def dedupe_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = levels(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "event_timestamp"))
    return dedupe_first(rows, ["equipment_id", "hour"], LEVEL_ORDER)


def stuck_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    keys = level_runs(spark, sf_dir).filter("is_stuck")
    return merge.split_on_keys(levels(spark, sf_dir), keys, ["equipment_id", "event_timestamp"])


@query
def split_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuck_split(spark, sf_dir)[0].select("seq", "equipment_id", "level")


@query
def split_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuck_split(spark, sf_dir)[1].select("seq", "equipment_id", "level")


# --- raw history -----------------------------------------------------------------------


@query
def raw_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even rows as the stored table, odd ones as new writes, some of them to the same keys."""
    rows, odd = raw_rows(spark, sf_dir), F.col("seq") % 2 == 1
    keys = ["equipment_type", *raw.RAW_KEYS]
    stored = merge.raw_upsert(rows.filter(~odd), None, keys, "seq")
    later = rows.filter(odd).withColumn("seq", F.col("seq") + LATER)
    return merge.raw_upsert(later, stored, keys, "seq")


def merged_raw_table(spark: SparkSession, sf_dir: str) -> str:
    path = workspace(spark, "raw")
    odd = F.col("seq") % 2 == 1
    rows = raw_rows(spark, sf_dir)
    tables.upsert_raw_table(rows.filter(~odd), path, "seq")
    later = rows.filter(odd).withColumn("seq", F.col("seq") + LATER)
    tables.upsert_raw_table(later, path, "seq")
    return path


@query
def raw_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges into a stored table partitioned by day: even rows, then odd ones."""
    rows = spark.read.parquet(merged_raw_table(spark, sf_dir))
    return rows.select(*_text_keys(), "timestamp", "state", "speed", "seq")


@query
def history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One equipment's days out of the stored raw table, which lies by day and id."""
    rows = spark.read.parquet(merged_raw_table(spark, sf_dir))
    days = [datetime.strptime(d, "%Y-%m-%d").date() for d in HISTORY_DAYS]
    found = raw.history(rows, "7", days)
    return found.select(*_text_keys(), "timestamp", "state", "speed", "seq")


def _text_keys() -> list[Column]:
    """Partition columns come back typed; the raw table's keys are text."""
    return [
        F.col("equipment_type"),
        F.col("equipment_id"),
        F.col("day_bucket").cast("string").alias("day_bucket"),
    ]


@query
def scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "raw")
    rows = raw_rows(spark, sf_dir).drop("seq")
    others = rows.withColumn("equipment_type", F.lit("tractor"))
    both = rows.unionByName(others)
    both.write.partitionBy("equipment_type", "day_bucket").parquet(path)
    scanned = raw.scan_raw(spark, path, "elevator")
    return scanned.withColumn("day_bucket", F.col("day_bucket").cast("string"))


@query
def equipment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_rows(spark, sf_dir)
    return raw.history(rows, "7", HISTORY_DAYS).select(
        "equipment_id", "day_bucket", "timestamp", "state", "speed"
    )


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an exported sheet: all text, some rows blank, some times unreadable."""
    blank = F.col("event_id") % 10 == 0
    sheet = table(spark, sf_dir, "events").select(
        F.when(~blank, F.col("event_id").cast("string")).alias("seq"),
        F.when(~blank, F.col("user_id").cast("string")).alias("equipment_id"),
        F.when(~blank, F.upper("event_type")).alias("type"),
        F.when(
            ~blank & (F.col("event_id") % 13 != 0),
            F.when(F.col("event_id") % 17 == 0, "soon").otherwise(
                F.date_format(F.col("ts").cast("timestamp"), time.IMPORT_FORMAT)
            ),
        ).alias("timestamp"),
        F.when(~blank, F.col("user_id") % 9).cast("string").alias("speed"),
    )
    return sheet


@query
def drop_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.drop_blank_rows(exported(spark, sf_dir))


@query
def import_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export to CSV, import, drop blank rows, date the rest; unreadable rows say why."""
    path = workspace(spark, "sheet")
    exported(spark, sf_dir).write.option("header", True).csv(path)
    sheet = raw.drop_blank_rows(raw.import_file(spark, path))
    rows, rejected = raw.prepare_import(sheet, AS_OF)
    return quality.union_rejects(rows, rejected.drop("timestamp")).select(
        "seq", "equipment_id", "type", "speed", "timestamp", "day_bucket", "reject_reason"
    )


def exported_folder(spark: SparkSession, sf_dir: str) -> str:
    """The sheet as files of two headers: odd rows have their columns the other way round."""
    path, sheet = workspace(spark, "sheets"), exported(spark, sf_dir)
    odd = F.coalesce(F.col("seq").cast("bigint") % 2 == 1, F.lit(False))
    write = lambda df: df.write.mode("append").option("header", True).csv(path)
    write(sheet.filter(~odd))
    write(sheet.filter(odd).select(*reversed(sheet.columns)))
    return path


@query
def import_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``import_file``, over files whose headers differ."""
    sheet = raw.drop_blank_rows(raw.import_folder(spark, exported_folder(spark, sf_dir)))
    rows, rejected = raw.prepare_import(sheet, AS_OF)
    return quality.union_rejects(rows, rejected.drop("timestamp")).select(
        "seq", "equipment_id", "type", "speed", "timestamp", "day_bucket", "reject_reason"
    )


SHEET_KINDS = [k for k in EVENT_KINDS if k.name != "view"]


def ingested(spark: SparkSession, sf_dir: str) -> Tables:
    stored = Tables(workspace(spark, "ingest"))
    ingest_files(spark, exported_folder(spark, sf_dir), stored, 0, AS_OF, SHEET_KINDS)
    return stored


def ingested_parts(spark: SparkSession, stored: Tables) -> DataFrame:
    rows = spark.read.parquet(stored.raw).select(F.col("equipment_type").alias("part"))
    rejected = spark.read.parquet(stored.rejected_import)
    both = rows.unionByName(rejected.select(F.col("reject_reason").alias("part")))
    return both.groupBy("part").agg(F.count("*").alias("row_count"))


@query
def raw_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets that arrive in three turns, the stream started anew for each: one ingest of all."""
    stored, home = Tables(workspace(spark, "arrivals")), workspace(spark, "sheets")
    sheet = exported(spark, sf_dir)
    third = F.coalesce(F.pmod(F.xxhash64("seq", "type", "equipment_id"), F.lit(3)), F.lit(0))
    for turn in range(3):
        part = sheet.filter(third == turn)
        part = part.select(*reversed(sheet.columns)) if turn else part
        part.write.mode("append").option("header", True).csv(f"{home}/inbox")
        start_ingest_stream(
            spark, f"{home}/inbox", stored, f"{home}/checkpoint", AS_OF, SHEET_KINDS, trigger=ONCE
        ).awaitTermination()
    return ingested_parts(spark, stored)


@query
def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to raw table: rows by type, and rejects by reason."""
    return ingested_parts(spark, ingested(spark, sf_dir))


@query
def publish_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw table as keyed messages."""
    messages = raw_messages(spark, ingested(spark, sf_dir), SHEET_KINDS)
    at = F.get_json_object("value", "$.timestamp").alias("timestamp")
    return messages.select("topic", "key", at)


@query
def route_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.drop_blank_rows(exported(spark, sf_dir))
    known, unknown = raw.route_by_type(rows, [k for k in EVENT_KINDS if k.name != "view"])
    routed = quality.union_rejects(known, unknown)
    return routed.groupBy("equipment_type", "type").agg(F.count("*").alias("row_count"))


def stored_verdicts(spark: SparkSession, clean: str, rejected: str) -> DataFrame:
    """What the clean table and the dead letter hold together."""
    topic = F.concat(F.col("equipment_type"), F.lit("_data")).alias("topic")
    good = tables.open_clean(spark, clean).select(
        topic, "equipment_id", "event_timestamp", F.lit(None).cast("string").alias("reject_reason")
    )
    return good.unionByName(verdicts(tables.read_rejected(spark, rejected)))


# --- warehouse -------------------------------------------------------------------------


def dim_of(rows: DataFrame) -> DataFrame:
    """The readings' dimension, staged: its keys are counted off once."""
    return stage(warehouse.build_dim_equipment({READING.name: rows}, kinds=[READING]), "dim")


def reading_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Facts and dimension of all readings, which are parsed and checked once."""
    rows = stage(valid_readings(spark, sf_dir), "valid")
    dim = dim_of(rows)
    return warehouse.hourly_backfill(rows, dim, READING, FIRST_HOUR, LAST_HOUR), dim


@query
def hour_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warehouse.hour_window(
        valid_readings(spark, sf_dir), "event_timestamp", time.target_hour(AS_OF)
    )
    return rows.select("seq", "equipment_id", "event_timestamp")


@query
def hourly_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last complete hour before the reference moment."""
    rows = stage(valid_readings(spark, sf_dir), "valid")
    return warehouse.hourly_fact(rows, dim_of(rows), READING, AS_OF)


@query
def hourly_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_star(spark, sf_dir)[0]


@query
def supplier_hourly_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact over every ``lineitem`` row, keyed by the supplier dimension."""
    by_id = warehouse.hourly_by_id(shipments(spark, sf_dir), SHIPMENT)
    return warehouse.with_equipment_key(by_id, supplier_dim(spark, sf_dir))


@query
def nation_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet roll-up of the supplier facts of one nation, filtered on the dimension."""
    dim = supplier_dim(spark, sf_dir)
    fact = warehouse.with_equipment_key(
        warehouse.hourly_by_id(shipments(spark, sf_dir), SHIPMENT), dim
    )
    some = dim.filter(F.col("nation_key") == 3).select("equipment_key")
    return serving.fleet(fact.join(some, "equipment_key", "left_semi"))


@query
def dim_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of five event types; an id found in several takes the first one's type."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("equipment_id"), "event_type"
    )
    parts = {k.name: events.filter(F.col("event_type") == k.name) for k in EVENT_KINDS}
    return warehouse.build_dim_equipment(parts, kinds=EVENT_KINDS).drop("created_at")


@query
def dim_equipment_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers exist; event ids that are no supplier are numbered after them."""
    existing = supplier_dim(spark, sf_dir).select(
        "equipment_key", "equipment_id", F.lit("SUPPLIER").alias("equipment_type")
    )
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("equipment_id"))
    new = warehouse.build_dim_equipment({READING.name: events}, existing, kinds=[READING])
    return existing.unionByName(new.drop("created_at"))


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that never appear as an event's user."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return merge.insert_if_absent(orders, table(spark, sf_dir, "events"), ["user_id"])


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_date_rows(table(spark, sf_dir, "orders"), "o_orderdate")


@query
def dim_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per calendar day, from the day range's own dimension."""
    days = warehouse.build_dim_date(spark, FIRST_HOUR.date(), LAST_HOUR.date())
    events = warehouse.with_date_hour_keys(levels(spark, sf_dir), "event_timestamp")
    daily = events.groupBy("date_key").agg(F.count("*").alias("measurement_count"))
    return days.join(daily, "date_key", "left").select(
        "date_key", "day_of_week", "week_of_year", "is_weekend",
        F.coalesce("measurement_count", F.lit(0)).alias("measurement_count"),
    )


@query
def dim_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms and readings by hour of the day, all days together."""
    keyed = warehouse.with_date_hour_keys(valid_readings(spark, sf_dir), "event_timestamp")
    by_hour = keyed.groupBy("hour_key").agg(
        F.count("*").alias("measurement_count"),
        F.count_if(READING.incident.predicate()).alias("alarm_count"),
    )
    return warehouse.build_dim_hour(spark).join(by_hour, "hour_key", "left")


def rejected_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rejections, with the event type as topic."""
    return warehouse.rejected_hourly(
        rejected_by_type(spark, sf_dir), FIRST_HOUR, LAST_HOUR + timedelta(days=1)
    )


@query
def rejected_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_fact(spark, sf_dir)


@query
def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stale facts, of which even hours are replaced whole and odd ones merged by key."""
    path = workspace(spark, "fact")
    fact = rejected_fact(spark, sf_dir)
    keys = warehouse.REJECTED_FACT_KEYS
    stale = fact.withColumn("rejected_count", F.lit(-1).cast("bigint"))
    tables.upsert_fact(stale, path)
    tables.upsert_fact(fact.filter(F.col("hour_key") % 2 == 0), path)
    # Odd hours keep the stale rows of one topic: its new rows are not written.
    odd = fact.filter((F.col("hour_key") % 2 == 1) & (F.col("topic") != "view"))
    tables.upsert_fact(odd, path, mode="key", keys=keys)
    return spark.read.parquet(path).select(*keys, "rejected_count")


@query
def sink_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of all kinds in one partitioned table."""
    stored = Tables(workspace(spark, "clean"))
    valid, _ = quality.split_valid(clean_batch(telemetry(spark, sf_dir)))
    tables.write_clean(tables.clean_rows(valid), stored.clean, batch_id=0)
    return tables.open_clean(spark, stored.clean).select(
        "equipment_type", "equipment_id", "event_timestamp", "state"
    )


@query
def batch_loads_stuck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads into the same tables: together the verdicts of one load."""
    stored = Tables(workspace(spark, "loads"))
    for number, part in enumerate(slices(telemetry(spark, sf_dir))):
        clean_to_tables(part, stored, batch_id=number)
    return stored_verdicts(spark, stored.clean, stored.rejected)


@query
def late_hours_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth equipment arrives in a batch of its own, hours after the others' facts.

    The job finds the hours by itself, each time; facts are those of all messages at once.
    """
    stored, messages = Tables(workspace(spark, "late")), telemetry(spark, sf_dir)
    late = F.col("key").cast("bigint") % 5 == 0
    first, second, third = slices(messages.filter(~late))
    for number, part in enumerate([first, messages.filter(late), second.unionByName(third)]):
        clean_to_tables(part, stored, batch_id=number)
        load_changed_hours(spark, stored, LAST_HOUR + timedelta(days=1))
    return warehouse_totals(spark, stored)


@query
def equipment_ids_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of three loads, from what each stored beside its readings."""
    stored = Tables(workspace(spark, "ids"))
    for number, part in enumerate(slices(telemetry(spark, sf_dir))):
        clean_to_tables(part, stored, batch_id=number)
    return serving.known_ids(tables.read_ids(spark, stored.clean))


@query
def compacted_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, the first two merged to one set of files, their own folders deleted."""
    stored = Tables(workspace(spark, "merged"))
    for number, part in enumerate(slices(telemetry(spark, sf_dir))):
        clean_to_tables(part, stored, batch_id=number)
    merge_batches(spark, stored, before=2)
    drop_merged(spark, stored)
    return stored_verdicts(spark, stored.clean, stored.rejected)


@query
def latest_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than a request may ask for, from the newest days of a stored table."""
    stored = Tables(workspace(spark, "latest"))
    clean_to_tables(telemetry(spark, sf_dir), stored, batch_id=0)
    clean = tables.read_clean(spark, stored.clean, KINDS[0])
    return serving.latest(clean, limit=MANY, day_col="event_date").select(
        "equipment_id", "event_timestamp"
    )


@query
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to tables to warehouse: equipment by equipment, what its facts add up to."""
    stored = Tables(workspace(spark, "warehouse"))
    clean_to_tables(telemetry(spark, sf_dir), stored, batch_id=0)
    # The second load starts inside the first one's hours and goes on to the end.
    load_hours(spark, stored, FIRST_HOUR, CUT)
    load_hours(spark, stored, CUT - timedelta(hours=5), LAST_HOUR)
    return warehouse_totals(spark, stored)


def warehouse_totals(spark: SparkSession, stored: Tables) -> DataFrame:
    totals = []
    for kind in KINDS:
        fact = tables.read_fact(spark, stored.fact(kind), kind)
        measure = kind.measures[0]
        totals.append(
            fact.groupBy("equipment_key").agg(
                F.count("*").alias("hours"),
                F.sum("measurement_count").alias("measurement_count"),
                F.sum(kind.incident.count_name).alias("incident_count"),
                F.max(f"max_{measure}").alias("max_measure"),
            )
        )
    dim = spark.read.parquet(stored.path("dim_equipment")).drop("created_at")
    return quality.union_rejects(*totals).join(dim, "equipment_key").drop("equipment_key")


# --- serving ---------------------------------------------------------------------------


@query
def equipment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.equipment_ids(valid_readings(spark, sf_dir))


@query
def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest(valid_readings(spark, sf_dir), limit=100)


@query
def latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest(valid_readings(spark, sf_dir), "7", limit=20)


@query
def hourly_by_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.hourly(*reading_star(spark, sf_dir), "7", hours=48)


@query
def hourly_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.hourly(*reading_star(spark, sf_dir), hours=48)


@query
def hourly_fleet_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.hourly(
        *reading_star(spark, sf_dir), "all", hours=720, weighted=True
    )


@query
def last_hours_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.last_hours_filter(rejected_fact(spark, sf_dir), 30, AS_OF)


@query
def rejected_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.rejected_summary(rejected_fact(spark, sf_dir), 24, as_of=AS_OF)


@query
def rejected_summary_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.rejected_summary(rejected_fact(spark, sf_dir), 1, as_of=AS_OF, legacy=True)


@query
def rejected_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = serving.rejected_summary(rejected_fact(spark, sf_dir), 720, as_of=AS_OF)
    return serving.rejected_total(summary)


@query
def rejected_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = serving.rejected_recent(dead_letters(spark, sf_dir), 50)
    return recent.select("topic", "equipment_id", "reject_reason", "rejected_at")


# --- streams ---------------------------------------------------------------------------

ONCE = {"availableNow": True}


def run_stream(
    spark: SparkSession,
    name: str,
    parts: Sequence[DataFrame],
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Feed ``parts`` one after the other through ``build`` into a table; read the table."""
    home = workspace(spark, name)
    inbox, outbox = f"{home}/inbox", f"{home}/outbox"

    def start():
        source = spark.readStream.schema(parts[0].schema).parquet(inbox)
        return (
            build(source)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{home}/checkpoint")
            .option("path", outbox)
            .outputMode("append")
            .trigger(**ONCE)
            .start()
        )

    replay(parts, inbox, start)
    return spark.read.parquet(outbox)


@query("stream_source")
def stream_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "topics")
    inbox = f"{home}/inbox"
    kinds = [k for k in KINDS if k.name != "sts"]

    def start():
        source = stream_source(spark, kinds, fmt="parquet", path=inbox, maxFilesPerTrigger="4")
        return (
            source.writeStream.format("parquet")
            .option("checkpointLocation", f"{home}/checkpoint")
            .option("path", f"{home}/outbox")
            .trigger(**ONCE)
            .start()
        )

    replay(slices(telemetry(spark, sf_dir)), inbox, start)
    return spark.read.parquet(f"{home}/outbox").select("topic", "key", "offset")


@query
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning stream over three slices: what both tables hold in the end."""
    home = workspace(spark, "clean-stream")
    inbox, clean, rejected = (f"{home}/{name}" for name in ("inbox", "clean", "rejected"))

    def start():
        return start_clean_stream(
            stream_source(spark, fmt="parquet", path=inbox),
            clean_path=clean,
            rejected_path=rejected,
            checkpoint=f"{home}/checkpoint",
            trigger=ONCE,
        )

    replay(slices(telemetry(spark, sf_dir)), inbox, start)
    return stored_verdicts(spark, clean, rejected)


@query
def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of a stream counted, three starts together."""
    home = workspace(spark, "counted-stream")

    def start():
        return start_clean_stream(
            stream_source(spark, fmt="parquet", path=f"{home}/inbox"),
            clean_path=f"{home}/clean",
            rejected_path=f"{home}/rejected",
            checkpoint=f"{home}/checkpoint",
            trigger=ONCE,
            counts_path=f"{home}/counts",
        )

    replay(slices(telemetry(spark, sf_dir)), f"{home}/inbox", start)
    names = [F.sum(c).alias(c) for c in ("valid_count", "rejected_count", "stuck_count")]
    return counts_of_batches(spark, f"{home}/counts").agg(F.count("*").alias("batches"), *names)


@query
def load_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds loaded as a batch, then three streamed into the same tables: rows of both."""
    stored, home = Tables(workspace(spark, "both")), workspace(spark, "both-stream")
    messages = telemetry(spark, sf_dir)
    loaded = F.col("topic").isin([k.topic for k in KINDS[:3]])
    clean_to_tables(messages.filter(loaded), stored, batch_id=0)

    def start():
        return start_clean_stream(
            stream_source(spark, fmt="parquet", path=f"{home}/inbox"),
            clean_path=stored.clean,
            rejected_path=stored.rejected,
            checkpoint=f"{home}/checkpoint",
            trigger=ONCE,
        )

    replay([messages.filter(~loaded)], f"{home}/inbox", start)
    return stored_verdicts(spark, stored.clean, stored.rejected)


@query("stuck_stream")
def stuck_stream_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = slices(levels(spark, sf_dir), "event_timestamp")
    runs = run_stream(
        spark, "stuck", parts, lambda s: stuck_stream(s, LEVEL_KEYS, LEVEL_ORDER, "level")
    )
    return runs.select("seq", "level", "run_length", "is_stuck")


def gappy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of which some lack the id, some the value."""
    return levels(spark, sf_dir).withColumns(
        {
            "equipment_id": F.when(F.col("seq") % 83 != 0, F.col("equipment_id")),
            "level": F.when(F.col("seq") % 41 != 0, F.col("level")),
        }
    )


@query
def stuck_runs_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = stuck_runs(gappy_levels(spark, sf_dir), LEVEL_KEYS, LEVEL_ORDER, "level")
    return runs.select("seq", "level", "run_length", "is_stuck")


@query
def stuck_stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = slices(gappy_levels(spark, sf_dir), "event_timestamp")
    runs = run_stream(
        spark, "stuck-gaps", parts, lambda s: stuck_stream(s, LEVEL_KEYS, LEVEL_ORDER, "level")
    )
    return runs.select("seq", "level", "run_length", "is_stuck")


@query("stuck_stream_ordered")
def stuck_stream_ordered_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh reading of a slice's last two days arrives a slice later, in its place none the less."""
    rows, edges = levels(spark, sf_dir), [timestamp_literal(b) for b in BORDERS]
    early, middle, last = slices(rows, "event_timestamp")
    late = lambda edge: F.coalesce(
        (F.col("seq") % 7 == 0) & (F.col("event_timestamp") >= edge - F.expr("INTERVAL 2 DAYS")), F.lit(False)
    )
    held = lambda part, edge: part.filter(late(edge))
    rest = lambda part, edge: part.filter(~late(edge))
    end = rows.limit(1).select(
        F.lit(-1).cast("bigint").alias("seq"),
        F.lit("end of the replay").alias("equipment_id"),
        F.lit(AS_OF + timedelta(days=60)).alias("event_timestamp"),
        F.lit(0.0).alias("level"),
    )
    parts = [
        rest(early, edges[0]),
        held(early, edges[0]).unionByName(rest(middle, edges[1])),
        held(middle, edges[1]).unionByName(last).unionByName(end),
    ]
    build = lambda s: stuck_stream_ordered(s, LEVEL_KEYS, LEVEL_ORDER, "level", "3 days")
    with rocksdb(spark):
        runs = run_stream(spark, "ordered", parts, build)
    return runs.select("seq", "level", "run_length", "is_stuck")


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that come a slice late, and some that come twice: kept, copies and late rows are all of them."""
    first, second, third = slices(levels(spark, sf_dir), "event_timestamp")
    late, twice = F.col("seq") % 31 == 0, F.col("seq") % 50 == 0
    parts = [
        first.filter(~late),
        second.filter(~late).unionByName(first.filter(late | twice)),
        third.unionByName(second.filter(late | twice)),
    ]
    judged = run_stream(spark, "late", parts, lambda s: admit(s, LEVEL_KEYS, delay="3 days"))
    return judged.select("seq", "verdict")


@query
def stream_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first slice loaded, the others streamed from the state the load left: verdicts of one load."""
    stored, home = Tables(workspace(spark, "first-load")), workspace(spark, "then-stream")
    first, *others = slices(telemetry(spark, sf_dir))
    clean_to_tables(first, stored, batch_id=0)

    def start():
        return start_clean_stream(
            stream_source(spark, fmt="parquet", path=f"{home}/inbox"),
            clean_path=stored.clean,
            rejected_path=stored.rejected,
            checkpoint=f"{home}/checkpoint",
            trigger=ONCE,
            begin_from=loaded_state(spark, stored),
        )

    replay(others, f"{home}/inbox", start)
    return stored_verdicts(spark, stored.clean, stored.rejected)


@query
def stream_hourly_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours as they stand after the last slice, open ones among them: all facts of all readings."""
    home, parts = workspace(spark, "hours"), slices(valid_readings(spark, sf_dir), "event_timestamp")

    def start():
        source = spark.readStream.schema(parts[0].schema).parquet(f"{home}/inbox")
        return start_hourly_stream(source, READING, f"{home}/hours", f"{home}/checkpoint", trigger=ONCE)

    replay(parts, f"{home}/inbox", start)
    return hourly_now(spark, f"{home}/hours", READING).drop("provisional")


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th reading arrives a second time, one slice later."""
    rows = levels(spark, sf_dir)
    first, second, third = slices(rows, "event_timestamp")
    again = lambda part: part.filter(F.col("seq") % 50 == 0)
    parts = [first, second.unionByName(again(first)), third.unionByName(again(second))]
    keys = ["equipment_id", "event_timestamp"]
    kept = run_stream(
        spark, "dedupe", parts, lambda s: dedupe_stream(s, keys, delay="30 days")
    )
    return kept.select("equipment_id", "event_timestamp", "level")


@query("stream_hourly")
def stream_hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour once it is complete; a reading of two days later, which stays open itself, completes the last."""
    rows = valid_readings(spark, sf_dir)
    *parts, last = slices(rows, "event_timestamp")
    end = rows.orderBy(F.desc("event_timestamp")).limit(1).withColumns(
        {
            "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 2 DAYS"),
            "equipment_id": F.lit("end of the replay"),
        }
    )
    parts.append(last.unionByName(end))
    return run_stream(spark, "hourly", parts, lambda s: stream_hourly(s, READING, "1 hour"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: readings to validated, deduplicated, hourly facts by equipment."""
    return QUERIES["hourly_backfill"](spark, sf_dir)

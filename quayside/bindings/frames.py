"""The ``events`` and ``lineitem`` tables seen as equipment telemetry.

``readings``: one simple kind, straight from the columns of ``events``.
``telemetry``: JSON messages of the six real kinds, computed from ``events``,
with the faults that validation has to find: missing and blank ids, missing and
unreadable timestamps, missing and out-of-range measures, cut-off JSON, copies.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.catalogue import ALARM, KINDS, Incident, Kind
from quayside.functions import time
from quayside.session import workspace
from quayside.sources.raw import with_day_bucket

AS_OF = datetime(2024, 1, 15, 19, 30)
#: Events whose messages one task writes.
ROWS_PER_TASK = 1_000_000

READING = Kind(
    name="reading",
    topic="reading",
    label="Reading",
    type_tag="READING",
    message=(
        "equipment_id STRING, type STRING, timestamp STRING, state STRING, value DOUBLE, "
        "k DOUBLE, engine_hours DOUBLE, alarm STRING"
    ),
    limits=(("value", 0, 150), ("k", 0, 90)),
    text_fields=("state", "alarm"),
    watched="value",
    incident=Incident("alarm", "alarm_count", "NONE", negated=True),
)

SHIPMENT = Kind(
    name="shipment",
    topic="shipment",
    label="Shipment",
    type_tag="SHIPMENT",
    message=(
        "equipment_id STRING, timestamp STRING, quantity DOUBLE, price DOUBLE, alarm STRING"
    ),
    limits=(("quantity", 0, 50), ("price", 0, 100000)),
    text_fields=("alarm",),
    watched="quantity",
    incident=ALARM,
    counter=None,
)

# Event types in the order in which an id shared by two of them gets its type.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_KINDS = tuple(
    Kind(t, t, t, t.upper(), READING.message, READING.limits, READING.text_fields, "value")
    for t in EVENT_TYPES
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _utc(c: Column) -> Column:
    """Zone-less time of the test tables as the engine's event time."""
    return c.cast("timestamp")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of kind ``READING``; ``seq`` is the arrival order."""
    text = F.date_format(_utc(F.col("ts")), time.PUBLISH_FORMAT)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("topic"),
        F.when(_every(89), "  ").otherwise(F.col("user_id").cast("string")).alias("equipment_id"),
        F.lit("READING").alias("type"),
        F.when(_every(97), "").when(_every(101), "bad").otherwise(text).alias("timestamp"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")).alias("state"),
        F.when(~_every(53), F.col("value")).alias("value"),
        F.from_json("props", "k DOUBLE").getField("k").alias("k"),
        (F.col("event_id") / F.lit(10.0)).alias("engine_hours"),
        F.when(F.col("event_type") == "error", "overheat")
        .when(~_every(7), "none")
        .alias("alarm"),
        _utc(F.col("ts")).alias("arrived_at"),
    )


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose value is coarse enough to repeat: ``level``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("equipment_id"),
        _utc(F.col("ts")).alias("event_timestamp"),
        F.floor(F.col("value") / 25).cast("double").alias("level"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows from ``lineitem``: the supplier is the equipment."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("equipment_id"),
        _utc(F.col("l_shipdate")).alias("event_timestamp"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "R", "RETURNED").otherwise("NONE").alias("alarm"),
    )


def supplier_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("equipment_id"),
        (F.col("s_suppkey") + 1).alias("equipment_key"),
        F.col("s_nationkey").alias("nation_key"),
    )


# --- the six real kinds ---------------------------------------------------------


_TEXTS = {
    "timestamp": "CASE WHEN event_id % 97 != 0 THEN if(event_id % 101 = 0, 'bad', "
    f"date_format(ts, \"{time.PUBLISH_FORMAT}\")) END",
    "state": "CASE event_type WHEN 'click' THEN ' running ' WHEN 'view' THEN 'Idle' "
    "WHEN 'error' THEN 'maintenance' WHEN 'purchase' THEN 'WAITING ' ELSE 'parked' END",
    "alarm": "CASE WHEN event_type = 'error' THEN ' overheat' WHEN event_id % 7 != 0 THEN 'none' END",
    "status": "if(event_type = 'error', 'fault', 'ok')",
    "direction": "if(k % 2 = 0, 'up', 'down ')",
    "operation_mode": "if(k % 2 = 0, 'auto', ' manual')",
    "position": "k",
    "container_attached": "k % 2 = 0",
}


def _field(kind: Kind, name: str) -> str:
    """SQL text of one message field, computed from the columns of ``events``."""
    if name == "equipment_id":
        return f"CASE WHEN event_id % 89 != 0 THEN '{kind.type_tag}-' || user_id END"
    if name == "type":
        return f"'{kind.type_tag}'"
    for i, (limited, low, high) in enumerate(kind.limits):
        if limited != name:
            continue
        share = f"((event_id * {7 + 2 * i} + k * {3 + i}) % 103) / 100D"
        if name == kind.watched:
            share = "least(floor(value / 25), 11) / 10D"
        every = 5 if name == kind.counter else 61
        value = f"{low}D + {high - low}D * {share}"
        return f"CASE WHEN (event_id + {13 * i}) % {every} != 0 THEN {value} END"
    return _TEXTS[name]


def _message(kind: Kind) -> str:
    fields = ", ".join(f"'{f}', {_field(kind, f)}" for f in kind.fields)
    return f"to_json(named_struct({fields}))"


def _spread(rows: DataFrame) -> DataFrame:
    """Rows dealt to all cores: a file of few row groups is read by as few tasks."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))
    return rows.repartition(tasks, "event_id")


def _computed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nth = F.col("user_id") % len(KINDS)
    topic = F.coalesce(*[F.when(nth == i, k.topic) for i, k in enumerate(KINDS)])
    cases = " ".join(f"WHEN {i} THEN {_message(k)}" for i, k in enumerate(KINDS))
    message = F.expr(f"CASE user_id % {len(KINDS)} {cases} END")
    first = F.col("event_id") * 2
    offsets = F.when(_every(50), F.array(first, first + 1)).otherwise(F.array(first))
    return (
        _spread(table(spark, sf_dir, "events"))
        .withColumn("k", F.from_json("props", "k BIGINT").getField("k"))
        # Exploded in a step of its own: beside a generator, structs lose their field names.
        .withColumn("offset", F.explode(offsets))
        .withColumn("message", message)
        .select(
            topic.alias("topic"),
            F.col("user_id").cast("string").alias("key"),
            F.when(_every(211), F.substring("message", 1, 20))
            .otherwise(F.col("message"))
            .alias("value"),
            "offset",
            _utc(F.col("ts")).alias("arrived_at"),
        )
    )


_message_tables: dict[tuple[str, str], str] = {}


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, key, value, offset`` messages of all six kinds, and ``arrived_at``.

    Every 50th message comes twice; every 211th is cut off. The messages play the
    part of the topics' logs, so an application writes them once, topic by topic.
    """
    application = (spark.sparkContext.applicationId, sf_dir)
    if application not in _message_tables:
        path = workspace(spark, "messages")
        _computed_messages(spark, sf_dir).write.partitionBy("topic").parquet(path)
        _message_tables[application] = path
    return spark.read.parquet(_message_tables[application])


def telemetry_of(spark: SparkSession, sf_dir: str, kind: Kind) -> DataFrame:
    return telemetry(spark, sf_dir).filter(F.col("topic") == kind.topic)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text raw rows with typed timestamp, several per key and day.

    A key is (equipment, day, twelve-hour mark); ``seq`` is the write order.
    """
    half_day = F.timestamp_seconds(F.floor(F.unix_seconds(_utc(F.col("ts"))) / 43200) * 43200)
    rows = table(spark, sf_dir, "events").select(
        F.lit("elevator").alias("equipment_type"),
        F.col("user_id").cast("string").alias("equipment_id"),
        half_day.alias("timestamp"),
        F.col("event_id").alias("seq"),
        F.when(~_every(3), F.col("event_type")).alias("state"),
        F.when(~_every(4), F.floor(F.col("value")).cast("bigint").cast("string")).alias("speed"),
    )
    return with_day_bucket(rows)

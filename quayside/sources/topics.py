"""Topic messages: the streaming source and the parsing of their JSON payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.catalogue import (
    KINDS,
    MAX_OFFSETS_PER_TRIGGER,
    Kind,
    merged_schema,
    owners,
    resolve,
    struct_of,
)
from quayside.functions.rules import is_kind
from quayside.functions.text import is_blank

MESSAGE_SCHEMA = struct_of("topic STRING, key STRING, value STRING, offset BIGINT")
_CORRUPT = "_corrupt"


def stream_source(
    spark: SparkSession,
    kinds: Sequence[str | Kind] = KINDS,
    *,
    fmt: str = "kafka",
    max_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    starting: str = "earliest",
    **opts: str,
) -> DataFrame:
    """One stream over the topics of ``kinds``: ``topic, key, value, offset``.

    ``kafka`` subscribes all topics in one query and reads at most ``max_per_trigger``
    offsets times the number of kinds per trigger; the topics share that limit by what they
    have to offer. Messages are keyed by equipment, so one equipment's lie in one partition,
    where ``offset`` orders them; offsets of different partitions are not compared. Any
    file format reads folders of messages with the same columns instead (``path`` option);
    there the limits are the format's own ``maxFilesPerTrigger`` and ``maxBytesPerTrigger``.
    """
    topics = [resolve(k).topic for k in kinds]
    reader = spark.readStream.format(fmt).options(**opts)
    if fmt == "kafka":
        return (
            reader.option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", max_per_trigger * len(topics))
            .load()
            .select("topic", "key", "value", "offset")
        )
    return reader.schema(MESSAGE_SCHEMA).load().filter(F.col("topic").isin(topics))


def _parsed(df: DataFrame, kept: list[str], schema: T.StructType, value_col: str) -> DataFrame:
    """``kept`` columns, ``source_json``, the payload's fields and ``parse_error``.

    The payload comes out of a generator: filters on its fields stay above it, so
    a later test of ``reject_reason`` does not parse the text a second time.
    """
    text = F.col(value_col).cast("string")
    readable = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    data = F.from_json(text, readable, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = df.select(*kept, text.alias("source_json"), F.inline(F.array(data)))
    error = is_blank(F.col("source_json")) | F.col(_CORRUPT).isNotNull()
    return parsed.withColumn("parse_error", error).drop(_CORRUPT)


def parse_payload(df: DataFrame, kind: str | Kind, value_col: str = "value") -> DataFrame:
    """Payload of one kind to its columns; other columns of ``df`` stay.

    Malformed JSON yields NULL fields, as the permissive parser does; the text
    stays in ``source_json`` and ``parse_error`` says that it was not read whole.
    """
    schema = resolve(kind).schema
    kept = [c for c in df.columns if c != value_col and c not in schema.fieldNames()]
    return _parsed(df, kept, schema, value_col).select(
        *kept, "source_json", "parse_error", *schema.fieldNames()
    )


def parse_mixed(
    df: DataFrame,
    kinds: Sequence[Kind] = KINDS,
    value_col: str = "value",
    topic_col: str = "topic",
) -> DataFrame:
    """Payloads of all kinds in one pass, into one wide row.

    Adds ``equipment_type`` from the topic; a field that a kind's message does
    not have stays NULL for that kind even when a payload carries it. Rows of
    unknown topics are left out.
    """
    kinds = tuple(kinds)
    schema = merged_schema(kinds)
    name_of = F.coalesce(*[F.when(F.col(topic_col) == k.topic, k.name) for k in kinds])
    kept = [c for c in df.columns if c != value_col and c not in schema.fieldNames()]

    def owned(name: str) -> str:
        having = [k.name for k in owners(name, kinds)]
        if len(having) == len(kinds):
            return f"`{name}`"
        return f"CASE WHEN {is_kind(having)} THEN `{name}` END AS `{name}`"

    known = df.filter(F.col(topic_col).isin([k.topic for k in kinds]))
    return (
        _parsed(known, kept, schema, value_col)
        .withColumn("equipment_type", name_of)
        .selectExpr(
            *kept, "equipment_type", "source_json", "parse_error", *map(owned, schema.names)
        )
    )

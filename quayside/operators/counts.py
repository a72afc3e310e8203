"""Row counts for operation: per batch, per topic, reject rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.catalogue import KINDS, STUCK_SENSOR, Kind


def outcome_counts() -> list[Column]:
    """Valid, rejected and stuck rows of a frame with a final ``reject_reason``."""
    reason = F.col("reject_reason")
    return [
        F.count_if(reason.isNull()).alias("valid_count"),
        F.count_if(reason.isNotNull()).alias("rejected_count"),
        F.count_if(reason == STUCK_SENSOR).alias("stuck_count"),
    ]


def observe_counts(df: DataFrame, name: str) -> DataFrame:
    """Count on the way: the figures come with the query's metrics, without a job."""
    return df.observe(name, *outcome_counts())


def batch_counts(df: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    return df.groupBy(*by).agg(*outcome_counts())


def topic_profile(df: DataFrame, topic: str = "topic", key: str = "equipment_id") -> DataFrame:
    """Rows and distinct equipments per topic.

    Counted per (topic, id) first: both steps combine before their shuffle, and
    no task sees all rows of a topic.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(topic, key)
        .agg(F.count("*").alias("_n"))
        .groupBy(topic)
        .agg(F.sum("_n").alias("row_count"), F.count("*").alias("equipment_count"))
    )


def reject_rate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejected share of all rows of a frame with a final ``reject_reason``."""
    rejected = F.count_if(F.col("reject_reason").isNotNull())
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        rejected.alias("rejected_count"),
        F.try_divide(rejected, F.count("*")).alias("reject_rate"),
    )


def unknown_fields(messages: DataFrame, kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """``topic, field, type, message_count``: payload fields that the catalogue does not know.

    Payloads are read as VARIANT, so a field's type is that of its values, message by
    message; a field of several types has a row for each. Text that is no JSON object has
    no fields, and topics that no kind has are left out.
    """
    known = F.coalesce(*[F.when(F.col("topic") == k.topic, F.array(*map(F.lit, k.fields))) for k in kinds])
    parsed = messages.select("topic", F.try_parse_json("value").alias("payload")).filter(
        F.schema_of_variant("payload").startswith("OBJECT<")
    )
    fields = messages.sparkSession.sql(
        "SELECT topic, key AS field, schema_of_variant(value) AS type FROM {parsed}, LATERAL variant_explode(payload)",
        parsed=parsed,
    )
    strange = fields.filter(~F.array_contains(known, F.col("field")))
    return strange.groupBy("topic", "field", "type").agg(F.count("*").alias("message_count"))

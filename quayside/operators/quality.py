"""Validation: reasons, split, clean columns, dead letter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.catalogue import KINDS, Kind, owners, resolve
from quayside.functions import rules
from quayside.functions.text import normalized
from quayside.functions.time import event_time

def normalize_text(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(
        *[normalized(F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns]
    )


def with_event_time(df: DataFrame, fmt: str | None = None) -> DataFrame:
    return df.withColumn("event_timestamp", event_time(F.col("timestamp"), fmt))


def with_reject_reason(
    df: DataFrame,
    kind: str | Kind,
    state_domain: Sequence[str] | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Normalise text, parse event time, add ``reject_reason`` (NULL = valid)."""
    k = resolve(kind)
    return with_event_time(normalize_text(df, k.text_fields), timestamp_format).withColumn(
        "reject_reason", rules.reject_reason(k, state_domain)
    )


def with_reject_reason_mixed(
    df: DataFrame,
    kinds: Sequence[Kind] = KINDS,
    state_domain: Sequence[str] | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """The same over wide rows of several kinds, told apart by ``equipment_type``."""
    kinds = tuple(kinds)

    def normal(name: str) -> Column:
        using = [k.name for k in kinds if name in k.text_fields]
        if not using:
            return F.col(name)
        value = normalized(F.col(name))
        if len(using) < len(owners(name, kinds)):
            value = F.when(F.expr(rules.is_kind(using)), value).otherwise(F.col(name))
        return value.alias(name)

    tidy = df.select(*[normal(c) for c in df.columns])
    return with_event_time(tidy, timestamp_format).withColumn(
        "reject_reason", rules.reject_reason_mixed(kinds, state_domain)
    )


def violations(df: DataFrame, kind: str | Kind) -> DataFrame:
    """Long form: one row per row and violated field, with ``rule`` and ``field``."""
    return (
        df.withColumn("_violation", F.explode(rules.violated_fields(resolve(kind))))
        .select("*", "_violation.rule", "_violation.field")
        .drop("_violation")
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (which need no ``reject_reason`` any more) and rejected rows."""
    reason = F.col("reject_reason")
    return df.filter(reason.isNull()).drop("reject_reason"), df.filter(reason.isNotNull())


def to_clean_columns(df: DataFrame, kind: str | Kind, extra: Sequence[str] = ()) -> DataFrame:
    """Drop the raw timestamp, rename, keep the kind's columns (and ``extra`` ones)."""
    k = resolve(kind)
    source = {new: old for old, new in k.renames.items()}
    return df.select(
        *[
            F.col(source[c]).alias(c) if source.get(c) in df.columns else F.col(c)
            for c in [*k.clean_columns, *extra]
        ]
    )


def payload(kind: Kind, columns: Sequence[str]) -> Column:
    """The row as JSON text under its clean names; NULL fields are left out."""
    source = {new: old for old, new in kind.renames.items()}
    fields = ", ".join(
        f"'{c}', `{source[c] if source.get(c) in columns else c}`" for c in kind.payload_columns
    )
    return F.expr(f"to_json(named_struct({fields}))")


def to_rejected(
    df: DataFrame, kind: str | Kind, rejected_at: Column | None = None
) -> DataFrame:
    """Rejected rows of one kind to dead-letter rows."""
    k = resolve(kind)
    return _dead_letter(df, F.lit(k.topic), payload(k, df.columns), rejected_at)


def to_rejected_mixed(
    df: DataFrame, kinds: Sequence[Kind] = KINDS, rejected_at: Column | None = None
) -> DataFrame:
    """Rejected wide rows to dead-letter rows; each payload lists its own kind's fields."""
    is_kind = [F.col("equipment_type") == k.name for k in kinds]
    topic = F.coalesce(*[F.when(test, k.topic) for test, k in zip(is_kind, kinds)])
    text = F.coalesce(*[F.when(test, payload(k, df.columns)) for test, k in zip(is_kind, kinds)])
    return _dead_letter(df, topic, text, rejected_at)


def _dead_letter(
    df: DataFrame, topic: Column, text: Column, rejected_at: Column | None
) -> DataFrame:
    source = F.col("source_json") if "source_json" in df.columns else F.lit(None).cast("string")
    at = rejected_at if rejected_at is not None else F.current_timestamp()
    return df.select(
        topic.alias("topic"),
        "equipment_id",
        text.alias("raw_payload"),
        "reject_reason",
        source.alias("source_json"),
        "event_timestamp",
        at.alias("rejected_at"),
    )


def union_rejects(*parts: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole

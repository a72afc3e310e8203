"""The star schema: dimensions, hourly facts, rejection fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.catalogue import KINDS, Kind, resolve
from quayside.functions import time
from quayside.operators.merge import count_off, insert_if_absent

HOUR = timedelta(hours=1)
FACT_KEYS = ("equipment_key", "date_key", "hour_key")
REJECTED_FACT_KEYS = ("date_key", "hour_key", "topic", "reject_reason")


def with_date_hour_keys(df: DataFrame, ts_col: str) -> DataFrame:
    ts = F.col(ts_col)
    return df.withColumns({"date_key": time.date_key(ts), "hour_key": time.hour_key(ts)})


def hour_window(
    df: DataFrame, ts_col: str, hour_start: datetime, hour_end: datetime | None = None
) -> DataFrame:
    """Rows of ``[hour_start, hour_end)``, one hour by default.

    Tables partitioned by the column's date also get the date range, which prunes
    partitions; the bounds on the time column alone would not.
    """
    end = hour_end or hour_start + HOUR
    ts = F.col(ts_col)
    rows = df.filter((ts >= time.timestamp_literal(hour_start)) & (ts < time.timestamp_literal(end)))
    day = {"event_timestamp": "event_date", "rejected_at": "rejected_date"}.get(ts_col)
    if day in df.columns:
        rows = rows.filter(F.col(day).between(hour_start.date(), end.date()))
    return rows


def dim_date_rows(days: DataFrame, date_col: str) -> DataFrame:
    """One calendar row per distinct date of ``date_col``; weeks are ISO weeks."""
    d = F.col("full_date")
    weekday = F.extract(F.lit("dayofweek_iso"), d).cast("int")
    return (
        days.select(F.col(date_col).cast("date").alias("full_date"))
        .filter(d.isNotNull())
        .distinct()
        .select(
            time.date_key(d).alias("date_key"),
            "full_date",
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            weekday.alias("day_of_week"),
            F.weekofyear(d).alias("week_of_year"),
            F.date_format(d, "MMMM").alias("month_name"),
            weekday.isin(6, 7).alias("is_weekend"),
        )
    )


def build_dim_date(spark: SparkSession, first: date, last: date | None = None) -> DataFrame:
    """Calendar rows from ``first`` to ``last`` (one day when omitted)."""
    count = ((last or first) - first).days + 1
    days = spark.range(count).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    return dim_date_rows(days, "d")


def target_date(as_of: datetime) -> date:
    return time.target_hour(as_of).date()


def build_dim_hour(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(
        F.col("id").cast("int").alias("hour_key"),
        F.concat(F.col("id").cast("string"), F.lit("h")).alias("hour_label"),
    )


def equipment_types(
    clean_by_kind: Mapping[str, DataFrame], kinds: Sequence[Kind] = KINDS
) -> DataFrame:
    """Distinct ids with the type of the first kind, in catalogue order, that has them."""
    tagged = [
        clean_by_kind[k.name].select("equipment_id", F.lit(rank).alias("_rank"))
        for rank, k in enumerate(kinds)
        if k.name in clean_by_kind
    ]
    whole = tagged[0]
    for part in tagged[1:]:
        whole = whole.unionByName(part)
    tags = F.array(*[F.lit(k.type_tag) for k in kinds])
    return (
        whole.filter(F.col("equipment_id").isNotNull())
        .groupBy("equipment_id")
        .agg(F.min("_rank").alias("_rank"))
        .select("equipment_id", F.get(tags, F.col("_rank")).alias("equipment_type"))
    )


def build_dim_equipment(
    clean_by_kind: Mapping[str, DataFrame],
    existing: DataFrame | None = None,
    kinds: Sequence[Kind] = KINDS,
    created_at: Column | None = None,
) -> DataFrame:
    """The rows to append: ids that ``existing`` lacks, numbered after its keys."""
    seen = equipment_types(clean_by_kind, kinds)
    new = seen if existing is None else insert_if_absent(seen, existing, ["equipment_id"])
    return count_off(new, "equipment_id", "equipment_key", existing).select(
        "equipment_key",
        "equipment_id",
        "equipment_type",
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )


def measure_aggregates(measures: Sequence[str]) -> list[Column]:
    return [
        f(m).alias(f"{name}_{m}")
        for m in measures
        for name, f in (("avg", F.avg), ("min", F.min), ("max", F.max))
    ]


def fact_aggregates(kind: Kind) -> list[Column]:
    incident = kind.incident
    aggregates = [
        F.count("*").alias("measurement_count"),
        F.count_if(incident.predicate()).alias(incident.count_name),
        *measure_aggregates(kind.measures),
    ]
    if kind.counter is not None:
        aggregates.append(F.max(kind.counter).alias(f"max_{kind.counter}"))
    return aggregates


def hourly_by_id(clean: DataFrame, kind: str | Kind, ts_col: str = "event_timestamp") -> DataFrame:
    """Hourly aggregates per equipment id. Readings combine before the shuffle."""
    return (
        with_date_hour_keys(clean, ts_col)
        .groupBy("equipment_id", "date_key", "hour_key")
        .agg(*fact_aggregates(resolve(kind)))
    )


def with_equipment_key(by_id: DataFrame, dim_equipment: DataFrame) -> DataFrame:
    """Natural id to surrogate key; ids the dimension lacks drop out.

    Joined after aggregating: the join meets one row per equipment and hour, not
    every reading, so it neither needs a broadcast nor suffers from a busy id.
    """
    values = [c for c in by_id.columns if c not in ("equipment_id", *FACT_KEYS)]
    keyed = by_id.join(dim_equipment.select("equipment_id", "equipment_key"), "equipment_id")
    return keyed.select(*FACT_KEYS, *values)


def hourly_backfill(
    clean: DataFrame,
    dim_equipment: DataFrame,
    kind: str | Kind,
    first_hour: datetime,
    last_hour: datetime,
) -> DataFrame:
    """Facts of every hour from ``first_hour`` to ``last_hour``, both included."""
    rows = hour_window(clean, "event_timestamp", first_hour, last_hour + HOUR)
    return with_equipment_key(hourly_by_id(rows, kind), dim_equipment)


def hourly_fact(
    clean: DataFrame, dim_equipment: DataFrame, kind: str | Kind, as_of: datetime
) -> DataFrame:
    """Facts of the last complete hour before ``as_of``."""
    hour = time.target_hour(as_of)
    return hourly_backfill(clean, dim_equipment, kind, hour, hour)


def rejected_hourly(
    rejected: DataFrame, hour_start: datetime, hour_end: datetime | None = None
) -> DataFrame:
    """Rejections per hour of processing, topic and reason; ``hour_end`` is excluded."""
    return rejections(hour_window(rejected, "rejected_at", hour_start, hour_end))


def rejections(rows: DataFrame) -> DataFrame:
    """``rejected_hourly`` of all ``rows``."""
    return (
        with_date_hour_keys(rows, "rejected_at")
        .groupBy(*REJECTED_FACT_KEYS)
        .agg(F.count("*").alias("rejected_count"))
    )

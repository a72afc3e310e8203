"""Partitioned Parquet tables, written so that a repeated write changes nothing.

Before a partitioned write, ``rebalance`` lets the runtime bring each partition
value's rows together and split the large ones again, so that files are neither
tiny nor one-per-hot-partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.catalogue import KINDS, Kind, owners, resolve, struct_of
from quayside.operators.merge import raw_upsert, upsert_by_key
from quayside.session import stage
from quayside.sinks import batches
from quayside.sources.raw import RAW_KEYS, text_days

FACT_PARTITIONS = ("date_key",)
REJECTED_SCHEMA = struct_of(
    "topic STRING, equipment_id STRING, raw_payload STRING, reject_reason STRING, "
    "source_json STRING, event_timestamp TIMESTAMP, rejected_at TIMESTAMP, "
    "writer STRING, batch_id BIGINT, rejected_date DATE"
)
_CLEAN_EXTRA = struct_of(
    "processed_at TIMESTAMP, writer STRING, batch_id BIGINT, equipment_type STRING, event_date DATE"
)
IDS_SCHEMA = struct_of(
    "equipment_type STRING, event_date DATE, equipment_id STRING, reading_count BIGINT"
).add("sketch", T.BinaryType())
CLEAN_PARTITIONS = ("equipment_type", "event_date")
REJECTED_PARTITIONS = ("rejected_date",)
RAW_PARTITIONS = ("equipment_type", "day_bucket")
#: Raw rows of a day lie by this column, which look-ups of one equipment go by.
RAW_CLUSTER = "equipment_id"
#: Different values that a file's Bloom filter is made for.
FILTERED_VALUES = 100_000


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in by])


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_batch(
    df: DataFrame, path: str, batch_id: int, partitions: Sequence[str], writer: str
) -> None:
    """Write a batch to its own folder; the same batch of the same writer again replaces it.

    Loads and streams number their batches independently, so each has its own folder:
    no writer ever replaces what another one has written.
    """
    batches.refuse_merged(df.sparkSession, path, batch_id, writer)
    (
        rebalanced(df, partitions)
        .write.mode("overwrite")
        .partitionBy(*partitions)
        .parquet(f"{path}/writer={writer}/batch_id={batch_id}")
    )


def clean_rows(
    valid: DataFrame, kinds: Sequence[Kind] = KINDS, processed_at: Column | None = None
) -> DataFrame:
    """Valid wide rows as the clean table stores them: renamed, with its partition columns.

    A kind that renames a field (``load``) stores it under its clean name.
    """
    renames = {old: new for k in kinds for old, new in k.renames.items()}
    for old in renames:
        if any(old not in k.renames for k in owners(old, tuple(kinds))):
            raise ValueError(f"{old} is renamed by some kinds only")
    columns = dict.fromkeys(c for k in kinds for c in k.clean_columns)
    source = {new: old for old, new in renames.items()}
    return valid.select(
        "equipment_type",
        *[F.expr(f"`{source.get(c, c)}` AS `{c}`") for c in columns],
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"),
        F.to_date("event_timestamp").alias("event_date"),
    )


def write_clean(df: DataFrame, path: str, batch_id: int, writer: str = "batch") -> None:
    write_batch(df, path, batch_id, CLEAN_PARTITIONS, writer)


def write_ids(clean: DataFrame, path: str, batch_id: int, writer: str = "batch") -> None:
    """Beside the clean table at ``path``: a batch's ids per kind and day, and a sketch of their number.

    ``clean`` are the rows that ``write_clean`` takes. A row per id, kind and day replaces a scan
    of the readings; sketches of any days and kinds can be united to an estimate.
    """
    ids = clean.groupBy("equipment_type", "event_date", "equipment_id").agg(
        F.count("*").alias("reading_count")
    )
    sketch = F.hll_sketch_agg("equipment_id").alias("sketch")
    days = ids.groupBy("equipment_type", "event_date").agg(sketch)
    rows = ids.unionByName(days, allowMissingColumns=True).hint("rebalance")
    rows.write.mode("overwrite").parquet(f"{path}_ids/writer={writer}/batch_id={batch_id}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids per kind and day of the clean table at ``path``, of all batches."""
    rows = spark.read.schema(IDS_SCHEMA).parquet(f"{path}_ids")
    return rows.filter("sketch IS NULL").select(*IDS_SCHEMA.names[:-1])


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(IDS_SCHEMA).parquet(f"{path}_ids")
    return rows.filter("sketch IS NOT NULL").select("equipment_type", "event_date", "sketch")


def write_rejected(df: DataFrame, path: str, batch_id: int, writer: str = "batch") -> None:
    dated = df.withColumn("rejected_date", F.to_date("rejected_at"))
    write_batch(dated, path, batch_id, REJECTED_PARTITIONS, writer)


def clean_schema(kinds: Sequence[Kind] = KINDS) -> T.StructType:
    """Stored columns of the clean table, partition columns last."""
    types = {k.clean_name(f.name): f.dataType for k in kinds for f in k.schema.fields}
    types["event_timestamp"] = T.TimestampType()
    columns = dict.fromkeys(c for k in kinds for c in k.clean_columns)
    return T.StructType([*[T.StructField(c, types[c]) for c in columns], *_CLEAN_EXTRA.fields])


def open_clean(spark: SparkSession, path: str, kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """The clean table of all kinds; its files are listed once, here."""
    return batches.read(spark, path, clean_schema(kinds))


def clean_of_kind(clean: DataFrame, kind: str | Kind) -> DataFrame:
    """One kind's rows: only its partitions and columns are read."""
    k = resolve(kind)
    rows = clean.filter(F.col("equipment_type") == k.name)
    return rows.select(*k.clean_columns, "processed_at", "event_date")


def read_clean(spark: SparkSession, path: str, kind: str | Kind) -> DataFrame:
    return clean_of_kind(open_clean(spark, path, [resolve(kind)]), kind)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return batches.read(spark, path, REJECTED_SCHEMA).drop("writer", "batch_id")


def read_fact(spark: SparkSession, path: str, kind: str | Kind) -> DataFrame:
    k = resolve(kind)
    doubles = [f"{f}_{m}" for m in k.measures for f in ("avg", "min", "max")]
    if k.counter is not None:
        doubles.append(f"max_{k.counter}")
    columns = [
        "equipment_key BIGINT, hour_key INT, measurement_count BIGINT",
        f"{k.incident.count_name} BIGINT",
        *[f"{c} DOUBLE" for c in doubles],
        "processed_at TIMESTAMP, date_key INT",
    ]
    return spark.read.schema(struct_of(", ".join(columns))).parquet(path)


def read_rejected_fact(spark: SparkSession, path: str) -> DataFrame:
    schema = struct_of(
        "hour_key INT, topic STRING, reject_reason STRING, rejected_count BIGINT, "
        "processed_at TIMESTAMP, date_key INT"
    )
    return spark.read.schema(schema).parquet(path)


def upsert_fact(
    df: DataFrame,
    path: str,
    mode: str = "hour",
    keys: Sequence[str] = ("equipment_key", "date_key", "hour_key"),
    hours: tuple[datetime, datetime] | None = None,
    whole: DataFrame | None = None,
) -> None:
    """Write facts into a table partitioned by ``date_key``.

    ``hour``: ``df`` holds whole hours and replaces them: those from ``hours[0]``
    to ``hours[1]`` included, those of ``whole`` (date_key, hour_key), or else those it
    has rows of. ``key``: ``df`` holds
    some rows of its hours; their other rows stay. Other hours always stay.

    Only the days of ``hours`` or ``whole``, or else of ``df``, are rewritten; of the former,
    days that have no rows any more are removed. The merge is staged, as it
    reads the partitions that it replaces. Partitions of an hour each would need
    no merge, but a fleet of a thousand would fill a table with tiny files.
    """
    if mode not in ("hour", "key"):
        raise ValueError(f"mode must be 'hour' or 'key', not {mode!r}")
    existing, emptied = read_if_exists(df.sparkSession, path), []
    if existing is not None:
        existing = existing.select(*df.columns)
        if hours is not None:
            first, last = (int(f"{h:%Y%m%d}") for h in hours)
            existing = existing.filter(F.col("date_key").between(first, last))
        elif whole is not None:
            touched = [r.date_key for r in whole.select("date_key").distinct().collect()]
            existing = existing.filter(F.col("date_key").isin(touched))
        else:
            existing = _touched(existing, df, FACT_PARTITIONS, "date_key")
        if mode == "key":
            merged = upsert_by_key(df, existing, keys)
        elif hours is not None:
            at = F.col("date_key") * 100 + F.col("hour_key")
            low, high = (int(f"{h:%Y%m%d%H}") for h in hours)
            merged = existing.filter(~at.between(low, high)).unionByName(df)
        elif whole is not None:
            merged = existing.join(whole, ["date_key", "hour_key"], "left_anti").unionByName(df)
        else:
            merged = upsert_by_key(df, existing, ["date_key", "hour_key"])
        df = stage(merged, "fact-merge")
        if hours is not None or whole is not None:
            days = existing.select("date_key").distinct()  # of the range: a row per day
            emptied = [r.date_key for r in days.join(df, "date_key", "left_anti").collect()]
    _overwrite_partitions(df, path, FACT_PARTITIONS)
    for day in emptied:
        batches.remove(df.sparkSession, f"{path}/date_key={day}")


def upsert_raw_table(new: DataFrame, path: str, seq_col: str) -> None:
    """Merge raw rows into their day partitions; other days are not touched."""
    existing = read_if_exists(new.sparkSession, path)
    keys = ["equipment_type", *RAW_KEYS]
    if existing is not None:
        existing = _touched(text_days(existing, path), new, RAW_PARTITIONS, "day_bucket")
    merged = stage(raw_upsert(new, existing, keys, seq_col), "raw-merge")
    _overwrite_partitions(merged, path, RAW_PARTITIONS, RAW_CLUSTER)


def _touched(
    existing: DataFrame, new: DataFrame, partitions: Sequence[str], day_col: str
) -> DataFrame:
    """Stored rows in partitions that ``new`` has rows of.

    A semi join does not prune the scan; the range of days, two values, does.
    """
    low, high = new.agg(F.min(day_col), F.max(day_col)).first()
    inside = F.lit(False) if low is None else F.col(day_col).between(F.lit(low), F.lit(high))
    touched = new.select(*partitions).distinct()
    return existing.filter(inside).join(touched, list(partitions), "left_semi")


def _overwrite_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], cluster: str | None = None
) -> None:
    """Replace the partitions that ``df`` has rows of.

    Inside them rows are dealt to files by ranges of ``cluster`` and sorted by it, and files have
    a Bloom filter of it, so a look-up of one value skips files, row groups and pages.
    """
    if cluster is None:
        dealt = rebalanced(df, partitions).write
    else:
        by = [*partitions, cluster]
        dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).write
        dealt = dealt.option(f"parquet.bloom.filter.enabled#{cluster}", "true")
        dealt = dealt.option(f"parquet.bloom.filter.expected.ndv#{cluster}", str(FILTERED_VALUES))
    (
        dealt.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    """Add rows whose keys are known to be new (dimensions)."""
    df.write.mode("append").parquet(path)

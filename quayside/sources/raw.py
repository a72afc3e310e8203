"""Raw, all-text history: imported files, per-kind tables, look-up by day bucket."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.catalogue import INVALID_TIMESTAMP, KINDS, Kind, resolve
from quayside.functions import text, time

RAW_KEYS = ("equipment_id", "day_bucket", "timestamp")


def import_file(spark: SparkSession, path: str) -> DataFrame:
    """Exported spreadsheets: a header row, then rows; every cell is text.

    Cells beyond the header are dropped, and columns follow header position. For one
    file, or files of one header; ``import_folder`` takes any.
    """
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def import_folder(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Many exported sheets at once, each read by its own header; columns meet by name.

    ``path`` may hold wildcards, or be a list. ``multi_line`` lets cells hold line breaks, at the price
    of files that are not split. The driver sees each file's name and header line only;
    files of equal header are read together.
    """
    first = F.min_by("value", "_line")
    headers = (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .filter((F.col("block") == 0) & (F.trim("value") != ""))
        .withColumn("_line", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(first.alias("header"))
        .collect()
    )
    alike: dict[str, list[str]] = {}
    for row in sorted(headers):
        alike.setdefault(row.header, []).append(unquote(row.file))
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    sheets = [reader.csv(files) for files in alike.values()]
    if not sheets:
        raise ValueError(f"no file with a header in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def route_by_type(
    df: DataFrame, kinds: Sequence[Kind] = KINDS, type_col: str = "type"
) -> tuple[DataFrame, DataFrame]:
    """Rows of known types, with ``equipment_type`` to partition by, and the rest."""
    name_of = F.coalesce(*[F.when(F.col(type_col) == k.type_tag, k.name) for k in kinds])
    routed = df.withColumn("equipment_type", name_of)
    known = routed.filter(F.col("equipment_type").isNotNull())
    unknown = routed.filter(F.col("equipment_type").isNull()).drop("equipment_type")
    return known, unknown


def parse_timestamp(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    return df.withColumn(col, time.event_time(F.col(col), fmt))


def prepare_import(df: DataFrame, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """Imported rows to raw rows, and the rows whose timestamp text is unreadable.

    A missing timestamp becomes ``as_of``; ``day_bucket`` follows the timestamp.
    """
    parsed = df.withColumn("_ts", time.event_time(F.col("timestamp"), time.IMPORT_FORMAT))
    unreadable = F.col("timestamp").isNotNull() & F.col("_ts").isNull()
    rejected = parsed.filter(unreadable).drop("_ts").withColumn(
        "reject_reason", F.lit(INVALID_TIMESTAMP)
    )
    rows = parsed.filter(~unreadable).withColumn("timestamp", F.col("_ts")).drop("_ts")
    return with_day_bucket(rows, as_of), rejected


def with_day_bucket(
    df: DataFrame, as_of: datetime | None = None, ts_col: str = "timestamp"
) -> DataFrame:
    """Add ``day_bucket``; with ``as_of``, a missing event time becomes ``as_of``."""
    if as_of is not None:
        df = df.withColumn(ts_col, F.coalesce(F.col(ts_col), time.timestamp_literal(as_of)))
    return df.withColumn("day_bucket", time.day_bucket(F.col(ts_col)))


def textify(df: DataFrame, keep: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Every column to text, except those in ``keep``."""
    return df.select(
        *[
            F.col(f.name)
            if f.name in keep
            else text.as_text(F.col(f.name), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def infer_type(df: DataFrame, kind: str | Kind) -> DataFrame:
    """Text columns of a raw table back to the catalogue's types."""
    types = {f.name: f.dataType for f in resolve(kind).schema.fields}
    raw = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(
        *[
            text.typed(F.col(c), types[c]).alias(c)
            if c in types and raw[c] == "string"
            else F.col(c)
            for c in df.columns
        ]
    )


def text_days(stored: DataFrame, path: str) -> DataFrame:
    """A stored raw table with ``day_bucket`` as the text it was written as.

    The reader takes a partition column of days for dates; a schema says otherwise.
    """
    fields = [
        T.StructField(f.name, T.StringType()) if f.name == "day_bucket" else f
        for f in stored.schema.fields
    ]
    return stored.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def scan_raw(spark: SparkSession, path: str, kind: str | Kind) -> DataFrame:
    """Full scan of one kind's raw table; the other kinds' partitions are not read."""
    k = resolve(kind)
    rows = text_days(spark.read.parquet(path), path).filter(F.col("equipment_type") == k.name)
    return rows.select(*[c for c in rows.columns if c in k.fields or c == "day_bucket"])


def history(df: DataFrame, equipment_id: str, day_buckets: Sequence[str]) -> DataFrame:
    """One equipment's rows of the given days, newest first.

    ``day_bucket`` is a partition column of raw tables, so only those days are read.
    """
    return df.filter(
        (F.col("equipment_id") == equipment_id) & F.col("day_bucket").isin(list(day_buckets))
    ).orderBy(F.col("timestamp").desc())

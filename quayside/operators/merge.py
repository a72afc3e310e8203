"""Key-wise joins and merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Number of hash buckets in which new surrogate keys are counted off.
KEY_BUCKETS = 4096


def split_on_keys(
    df: DataFrame, keys_df: DataFrame, on: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in ``keys_df``, and the others. Neither multiplies rows."""
    wanted = keys_df.select(*on).distinct()
    return df.join(wanted, list(on), "inner"), df.join(wanted, list(on), "left_anti")


def insert_if_absent(new: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``existing`` does not hold yet.

    Keys are made distinct before they are shuffled: a key that ``existing``
    repeats a billion times arrives once per map task.
    """
    return new.join(existing.select(*on).distinct(), list(on), "left_anti")


def upsert_by_key(new: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Existing rows, with those that ``new`` has under the same key replaced."""
    return insert_if_absent(existing, new, on).unionByName(new)


def raw_upsert(
    new: DataFrame, existing: DataFrame | None, keys: Sequence[str], seq_col: str
) -> DataFrame:
    """Last write wins, column by column; a NULL does not overwrite a value.

    Writes of one key combine before the shuffle, so many copies of a key cost
    one row per map task.
    """
    rows = new if existing is None else existing.unionByName(new, allowMissingColumns=True)
    values = [c for c in rows.columns if c not in keys and c != seq_col]
    newest = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq_col))).alias(c) for c in values
    ]
    return (
        rows.groupBy(*keys)
        .agg(*newest, F.max(seq_col).alias(seq_col))
        .select(*rows.columns)
    )


def count_off(new: DataFrame, id_col: str, key_col: str, existing: DataFrame | None) -> DataFrame:
    """Give each row of ``new`` the next surrogate key after those of ``existing``.

    Ids are ranked inside hash buckets; a bucket starts where the ones before it
    end. Only the bucket sizes (one row per bucket) meet in one task, and the
    result does not depend on how rows are distributed.
    """
    bucket = F.conv(F.substring(F.md5(F.col(id_col)), 1, 3), 16, 10).cast("int")
    new = new.withColumn("_bucket", bucket)
    sizes = new.groupBy("_bucket").agg(F.count("*").alias("_n"))
    if existing is not None:
        taken = existing.agg(
            F.lit(-1).alias("_bucket"), F.coalesce(F.max(key_col), F.lit(0)).alias("_n")
        )
        sizes = sizes.unionByName(taken)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(id_col))
    return (
        new.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_bucket")  # at most KEY_BUCKETS + 1 rows
        .withColumn(key_col, (F.col("_start") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_start")
    )

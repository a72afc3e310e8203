"""Sequences stored by key: buckets of keys, each sorted, that later jobs read without a shuffle.

All rows of a key lie in one bucket, so runs, copies and aggregates per key (and whatever
goes with it: a time, an hour) need no Exchange any more; the shuffle is paid once, when the
table is written. A bucket is one task: a key with a large share of all rows makes it long,
and such a table is better read from its day partitions, where ``stuck_runs`` cuts hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed when a table is begun; about as many as tasks shall read it.
BUCKETS = 64


def write_clustered(
    df: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Store ``df`` as catalogue table ``table`` below ``path``, one sorted file per bucket, and read it.

    Rows are dealt by the hash that buckets go by, so no task writes more than its own.
    Rows without a key are a key like any other.
    """
    columns = [F.col(c) for c in keys]
    (
        df.repartition(buckets, *columns)
        .sortWithinPartitions(*keys, *order)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys, *order)
        .option("path", path)
        .saveAsTable(table)
    )
    return read_clustered(df.sparkSession, table)


def read_clustered(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)

"""What the operators share: input columns, Arrow helpers, prefix sums, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.session import ship, stage

#: Bytes of one Arrow batch, as texts may be long.
BATCH_BYTES = 1 << 20
#: Rows up to which a staged table of a row per source or language is sent to all executors.
SENT_ROWS = 10_000


def prepare(spark: SparkSession) -> SparkSession:
    """What the Python operators need: the package, and batches that are bounded in bytes.

    This one setting is the same for all operators; it bounds memory and changes no result.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text`` and the columns named, null texts as empty ones.

    Rows without ``doc_id`` are no documents and are left out. Other columns are
    dropped here, so that their names cannot clash with those of an operator.
    """
    prepare(docs.sparkSession)
    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; documents with 2 are held out of all learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def text_bytes(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The UTF-8 bytes of all rows in one buffer, and the rows' bounds in it (rows + 1 values).

    Nulls count as empty.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return memoryview(data if data is not None else b""), bounds


def by_rows(spark: SparkSession, n: int, rows_per_task: int) -> int:
    """Partitions for ``n`` rows: so many rows each, and no fewer partitions than the session deals."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_task), 1)


def sent_if_small(staged: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """``staged``, marked for a broadcast if its rows are counted to be few; else joined by a shuffle."""
    return F.broadcast(staged) if staged.limit(rows + 1).count() <= rows else staged


def mapped(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    return df.mapInArrow(function, schema)


def batch(**columns: Sequence | np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible Latin-1 as it is, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in visible]
    return {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(hidden)}


def components(links: DataFrame, name: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes, about log(n)
    rounds. Each round is written to the shared folder, so a lost executor costs
    one round at most. A minimum per node is pre-aggregated on the map side; a hub
    with many links is split by the skew join.
    """
    now = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stage(now, name), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = stage(small.distinct(), name)

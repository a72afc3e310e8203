"""Batch folders of a table, and their merging into fewer files.

A batch lies in ``writer=w/batch_id=n``. Merging writes the rows of a writer's batches
from ``first`` to ``last`` to ``writer=merged-w-first/batch_id=last``. The marker that
Spark writes last, ``_SUCCESS``, is the commit: with it readers take the merged folder
and leave the batches in its range, without it the other way round. So each row is seen
once at any time, and a merge that was lost half-way is simply run again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MERGED = re.compile(r"merged-(.*)-(\d+)")


@dataclass(frozen=True)
class Folder:
    """Batches ``first`` to ``last`` of a writer."""

    path: str
    writer: str
    first: int
    last: int
    merged: bool

    @property
    def folder_writer(self) -> str:
        """The writer as the folder, and so the partition column, names it."""
        return f"merged-{self.writer}-{self.first}" if self.merged else self.writer

    def covers(self, other: Folder) -> bool:
        """A merge hides its batches; merges never reach over one another."""
        inside = self.first <= other.first and other.last <= self.last
        return self.merged and not other.merged and self.writer == other.writer and inside


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def named(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def written_at(spark: SparkSession, folder: str) -> int:
    """Milliseconds at which a folder was committed, 0 if it was not."""
    files, path = _file_system(spark, f"{folder}/_SUCCESS")
    return files.getFileStatus(path).getModificationTime() if files.exists(path) else 0


def remove(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def folders(spark: SparkSession, path: str) -> list[Folder]:
    """Batches and committed merges of a table: a name per folder, no files."""
    found = []
    for writer in named(spark, path, "writer="):
        merged = _MERGED.fullmatch(writer)
        for number in map(int, named(spark, f"{path}/writer={writer}", "batch_id=")):
            folder = f"{path}/writer={writer}/batch_id={number}"
            if merged is None:
                found.append(Folder(folder, writer, number, number, False))
            elif exists(spark, f"{folder}/_SUCCESS"):
                found.append(Folder(folder, merged[1], int(merged[2]), number, True))
    return found


def current(spark: SparkSession, path: str) -> list[Folder]:
    """The folders that hold each row of the table once."""
    found = folders(spark, path)
    merges = [f for f in found if f.merged]
    return [f for f in found if not any(m.covers(f) for m in merges)]


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    paths = [f.path for f in current(spark, path)]
    return spark.read.schema(schema).option("basePath", path).parquet(*(paths or [path]))


def refuse_merged(spark: SparkSession, path: str, batch_id: int, writer: str) -> None:
    """A merged batch can not be replaced any more: its rows lie among those of others."""
    if _MERGED.fullmatch(writer):
        raise ValueError(f"{writer} is the name of a merge")
    numbers = {
        first: named(spark, f"{path}/writer=merged-{writer}-{first}", "batch_id=")
        for name in named(spark, path, f"writer=merged-{writer}-")
        if name.isdigit() and (first := int(name)) <= batch_id
    }
    for first, lasts in numbers.items():
        for last in lasts:
            folder = f"{path}/writer=merged-{writer}-{first}/batch_id={last}"
            if batch_id <= int(last) and exists(spark, f"{folder}/_SUCCESS"):
                raise ValueError(f"batch {batch_id} of {writer} has been merged")


def merge(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: Sequence[str],
    before: int,
    writer: str,
) -> None:
    """Merge ``writer``'s batches below ``before`` that follow its last merge.

    A writer's merges run one at a time. A batch with a number below an earlier merge
    stays as it is, as a new range must not reach over that merge.
    These batches must be finished for good: a load that may be repeated, or a stream's
    batch that is not committed, has to have a number from ``before`` on.
    """
    own = [f for f in current(spark, path) if f.writer == writer]
    after = max((f.last for f in own if f.merged), default=-1)
    found = [f for f in own if not f.merged and after < f.last < before]
    if len(found) < 2:
        return
    first, last = min(f.first for f in found), max(f.last for f in found)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f.path for f in found])
    (
        rows.drop("writer", "batch_id")
        .hint("rebalance", *[F.col(c) for c in partitions])
        .write.mode("overwrite")
        .partitionBy(*partitions)
        .parquet(f"{path}/writer=merged-{writer}-{first}/batch_id={last}")
    )


def drop_merged(spark: SparkSession, path: str) -> None:
    """Delete batches that merges have replaced. Queries opened before the merge must have ended."""
    kept = {f.path for f in current(spark, path)}
    for folder in folders(spark, path):
        if folder.path not in kept:
            remove(spark, folder.path)

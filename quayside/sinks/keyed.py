"""Rows by key that batches change: small deltas, and a snapshot every so many of them.

Layout: ``part=delta/version=n`` holds the keys that batch ``n`` changed, and no others;
``part=snapshot/version=n`` holds all keys as they are after batch ``n``. A reader takes the
newest snapshot below a version and the deltas after it, and of each key the row of the
highest version. So what a batch writes follows from its own rows, what it reads is one
snapshot and a bounded number of deltas, and a repeated batch starts from the same rows and
replaces its own. The marker that Spark writes last, ``_SUCCESS``, commits a folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sinks import batches

#: Deltas after which a snapshot is made.
EVERY = 16
DELTA, SNAPSHOT = "delta", "snapshot"


class KeyedLog:
    """The table below one folder that all executors share. ``schema``: keys first, then values."""

    def __init__(self, path: str, keys: Sequence[str], schema: T.StructType, every: int = EVERY):
        self.path, self.keys, self.schema, self.every = path.rstrip("/"), list(keys), schema, every

    def _folder(self, part: str, version: int) -> str:
        return f"{self.path}/part={part}/version={version}"

    def versions(self, spark: SparkSession, part: str) -> list[int]:
        """Numbers of the folders, committed or not: one listing."""
        return sorted(map(int, batches.named(spark, f"{self.path}/part={part}", "version=")))

    def _committed(self, spark: SparkSession, part: str, version: int) -> bool:
        return batches.exists(spark, f"{self._folder(part, version)}/_SUCCESS")

    def _read(self, spark: SparkSession, version: int | None) -> tuple[int | None, list[int]]:
        """The newest snapshot below ``version`` (None: of all) and the deltas between."""
        below = lambda v: version is None or v < version
        snapshots = reversed([v for v in self.versions(spark, SNAPSHOT) if below(v)])
        base = next((v for v in snapshots if self._committed(spark, SNAPSHOT, v)), None)
        deltas = [v for v in self.versions(spark, DELTA) if below(v) and (base is None or v > base)]
        return base, [v for v in deltas if self._committed(spark, DELTA, v)]

    def before(
        self, spark: SparkSession, version: int | None = None, only: DataFrame | None = None
    ) -> DataFrame | None:
        """Each key's row as the versions below ``version`` left it; without it, as it is now.

        ``only`` holds the keys wanted; they are joined before versions are compared.
        """
        base, deltas = self._read(spark, version)
        paths = [self._folder(DELTA, v) for v in deltas]
        if base is not None:
            paths.append(self._folder(SNAPSHOT, base))
        if not paths:
            return None
        stored = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        rows = spark.read.schema(stored).option("basePath", f"{self.path}").parquet(*paths)
        if only is not None:
            rows = rows.join(only.select(*self.keys).distinct(), self.keys, "left_semi")
        if len(paths) > 1:
            values = [c for c in self.schema.names if c not in self.keys]
            newest = F.max_by(F.struct(*values), "version").alias("newest")
            rows = rows.groupBy(*self.keys).agg(newest).select(*self.keys, "newest.*")
        return rows.select(*self.schema.names)

    def write(self, rows: DataFrame, version: int) -> None:
        """Store the keys that ``version`` changes; what it wrote before is replaced."""
        spark = rows.sparkSession
        for stale in self.versions(spark, SNAPSHOT):  # they may hold what is replaced now
            if stale >= version:
                batches.remove(spark, self._folder(SNAPSHOT, stale))
        self._store(rows, DELTA, version)
        if len(self._read(spark, version + 1)[1]) >= self.every:
            self._store(self.before(spark, version + 1), SNAPSHOT, version)

    def begin(self, rows: DataFrame | None) -> None:
        """Make ``rows`` the table before its first version, unless it has begun already."""
        if rows is not None and not self.versions(rows.sparkSession, SNAPSHOT):
            if not self.versions(rows.sparkSession, DELTA):
                self._store(rows, SNAPSHOT, -1)

    def _store(self, rows: DataFrame, part: str, version: int) -> None:
        rows = rows.select(*self.schema.names).hint("rebalance")
        rows.write.mode("overwrite").parquet(self._folder(part, version))

    def forget(self, spark: SparkSession, version: int) -> None:
        """Remove what no batch from ``version`` on can read any more."""
        base, _ = self._read(spark, version)
        if base is not None:
            for part, last in ((DELTA, base), (SNAPSHOT, base - 1)):
                for old in self.versions(spark, part):
                    if old <= last:
                        batches.remove(spark, self._folder(part, old))

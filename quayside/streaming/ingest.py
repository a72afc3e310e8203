"""Exported sheets taken in as they arrive."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.catalogue import KINDS, Kind
from quayside.plans.etl import Tables, ingest_files

#: Sheets of one micro-batch: their names meet on the driver.
FILES_PER_BATCH = 1000


def start_ingest_stream(
    spark: SparkSession,
    folder: str,
    stored: Tables,
    checkpoint: str,
    as_of: datetime,
    kinds: Sequence[Kind] = KINDS,
    files_per_batch: int = FILES_PER_BATCH,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Every sheet of ``folder`` into the raw table, once.

    The stream's file log says which sheets are new; a batch of them is one load, whose
    number is the batch's. One that is repeated writes the same rows under the same number,
    and of equal keys the later batch wins, so neither a restart nor a lost executor shows.
    A raw table takes its loads from one stream, or from ``ingest_files``, as both number
    their loads from 0. Files should be moved into the folder whole.
    """
    sheets = spark.readStream.option("maxFilesPerTrigger", str(files_per_batch)).text(folder)
    names = sheets.select(F.col("_metadata.file_path").alias("file"))

    def take(batch: DataFrame, batch_id: int) -> None:
        files = sorted(unquote(r.file) for r in batch.distinct().collect())
        if files:
            ingest_files(batch.sparkSession, files, stored, batch_id, as_of, kinds)

    return (
        names.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )

"""Sinks outside Spark's own tables. Both append, and deliver at least once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

JDBC_BATCH = 1000


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    options = {"batchsize": str(JDBC_BATCH), **properties}
    df.write.jdbc(url, table, mode="append", properties=options)


# --- fixed values: delivery settings of the publisher -------------------------
KAFKA_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "20",
    "kafka.batch.size": "65536",
    "kafka.compression.type": "lz4",
}


def publish(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send ``key, value`` rows to one topic."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **KAFKA_OPTIONS, **options}
    messages.write.format("kafka").options(**settings).save()

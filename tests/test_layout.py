"""Stored layouts: what look-ups and sequences read and do not shuffle."""

from datetime import date

from helpers import elevator_messages, message
from pyspark.sql import functions as F

from quayside.catalogue import ELEVATOR, KINDS
from quayside.operators.dedupe import dedupe_first
from quayside.operators.stuck import stuck_runs
from quayside.plans import serving
from quayside.plans.etl import Tables, clean_to_tables
from quayside.session import workspace
from quayside.sinks import tables
from quayside.sinks.clustered import write_clustered
from quayside.sources import raw

KEYS, ORDER = ["equipment_id"], ["event_timestamp", "seq"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sequences(spark, n=2000):
    ids = F.when(F.col("id") % 97 != 0, (F.col("id") % 37).cast("string"))
    at = F.timestamp_seconds(1_700_000_000 + (F.col("id") * 7919) % 100_000)
    return spark.range(n).select(ids.alias("equipment_id"), at.alias("event_timestamp"), F.col("id").alias("seq"), (F.col("id") % 3).cast("double").alias("v"))


def test_sequences_of_a_clustered_table_are_not_shuffled(spark):
    rows, path = sequences(spark), workspace(spark, "clustered")
    stored = write_clustered(rows, f"t_{path.rsplit('-', 1)[1]}", path, KEYS, ORDER, buckets=4)
    assert stored.count() == rows.count() and len(stored.inputFiles()) <= 4
    hourly = lambda df: df.groupBy("equipment_id", F.date_trunc("hour", "event_timestamp").alias("hour")).agg(F.count("*").alias("n"))
    jobs = {
        "runs": lambda df: stuck_runs(df, KEYS, ORDER, "v", rows_per_piece=None),
        "first": lambda df: dedupe_first(df, ["equipment_id", "event_timestamp"], ["seq"]),
        "hours": hourly,
    }
    for job in jobs.values():
        assert "Exchange" not in plan(job(stored)) and "Exchange" in plan(job(rows))
        assert sorted(map(str, job(stored).collect())) == sorted(map(str, job(rows).collect()))


def test_look_up_of_one_id_skips_pages(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.page.row.count.limit", "100")
    try:
        day = F.lit("2026-01-01")
        rows = spark.range(20_000).select(
            F.lit("rmg").alias("equipment_type"), F.format_string("E%04d", (F.col("id") * 7919) % 400).alias("equipment_id"),
            F.timestamp_seconds(F.col("id")).alias("timestamp"), F.col("id").alias("seq"), F.lit("x").alias("state"), day.alias("day_bucket"),
        )
        path = workspace(spark, "raw")
        tables.upsert_raw_table(rows, path, "seq")
        tables.upsert_raw_table(rows.limit(0), path, "seq")
    finally:
        conf.unset("parquet.page.row.count.limit")
    stored = spark.read.parquet(path)
    found = stored.filter((F.col("equipment_id") == "E0007") & (F.col("day_bucket") == F.lit(date(2026, 1, 1))))
    assert len(found.collect()) == 50
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert 50 <= read <= 2000, read  # of 20 000 rows of the day
    newest_first = raw.history(stored, "E0007", [date(2026, 1, 1)])
    assert [r.seq for r in newest_first.collect()] == sorted((r.seq for r in found.collect()), reverse=True)


def test_ids_are_known_without_reading_a_reading(spark):
    stored = Tables(workspace(spark, "ids"))

    def load(batch, first, last, day):
        rows = [message(equipment_id=f"E{i}", timestamp=f"2026-01-{day:02d}T00:00:00") for i in range(first, last)]
        clean_to_tables(elevator_messages(spark, [*rows, message(equipment_id=None)], start=batch * 1000), stored, batch, [ELEVATOR])

    load(0, 0, 300, 1)
    load(1, 200, 500, 2)
    load(1, 200, 400, 2)  # the batch again, with other rows
    ids = tables.read_ids(spark, stored.clean)
    found = serving.known_ids(ids, "elevator")
    assert {r.equipment_id for r in found.collect()} == {f"E{i}" for i in range(400)}
    assert all("/clean_ids/" in f for f in found.inputFiles())
    assert serving.known_ids(ids, "elevator", [date(2026, 1, 2)]).count() == 200
    assert serving.known_ids(ids, "rmg").count() == 0
    (row,) = serving.id_estimates(tables.read_sketches(spark, stored.clean)).collect()
    assert row.equipment_type == "elevator" and abs(row.equipment_count - 400) <= 20


def test_messages_are_written_by_all_cores(spark, tmp_path):
    """A table of one row group is read by one task, and its messages by as many as there are files."""
    from quayside.bindings.frames import telemetry, telemetry_of

    rows = "id AS event_id, id % 12 AS user_id, 'view' AS event_type, timestamp_ntz'2024-01-02 00:00:00' AS ts, 10D AS value, '{\"k\": 1}' AS props"
    spark.range(4000).selectExpr(*rows.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    messages = telemetry(spark, str(tmp_path))
    assert messages.count() == 4080
    files = telemetry_of(spark, str(tmp_path), KINDS[0]).select(F.input_file_name()).distinct()
    assert files.count() == spark.sparkContext.defaultParallelism

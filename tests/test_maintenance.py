"""Hours found by what has changed, open hours, readings in their place and late rows."""

import contextlib
from datetime import datetime
from types import SimpleNamespace

import pytest
from helpers import elevator_messages, message
from pyspark.sql import functions as F

from quayside.catalogue import ELEVATOR, struct_of
from quayside.operators.stuck import stuck_runs
from quayside.plans.etl import Tables, clean_to_tables, load_hours, merge_batches
from quayside.plans.maintenance import ledger, load_changed_hours
from quayside.session import workspace
from quayside.sinks import tables
from quayside.streaming.ordered import PROVIDER, OrderedRuns, admit, rocksdb, stuck_stream_ordered
from quayside.streaming.windows import hourly_log, hourly_now, start_hourly_stream

ONCE = {"availableNow": True}
KIND = [ELEVATOR]


def at(day, hour, minute=0, **changes):
    return message(timestamp=f"2026-01-{day:02d}T{hour:02d}:{minute:02d}:00", speed=hour / 10 + minute / 100, **changes)


def load(spark, stored, batch, *payloads):
    clean_to_tables(elevator_messages(spark, payloads, start=1000 * batch), stored, batch, KIND)


def hours(rows):
    return sorted((r.hour.day, r.hour.hour) for r in rows.filter("source = 'clean'").collect())


def facts(spark, stored):
    rows = tables.read_fact(spark, stored.fact(ELEVATOR), ELEVATOR)
    return sorted((r.date_key % 100, r.hour_key, r.measurement_count) for r in rows.collect())


def test_job_finds_the_hours_itself(spark):
    stored, noon = Tables(workspace(spark, "late")), datetime(2026, 1, 3, 12, 30)
    load(spark, stored, 0, at(1, 5), at(1, 5, 1), at(2, 7), at(3, 12))
    assert hours(load_changed_hours(spark, stored, noon, KIND)) == [(1, 5), (2, 7)]  # the third is not over
    assert facts(spark, stored) == [(1, 5, 2), (2, 7, 1)]
    assert hours(load_changed_hours(spark, stored, noon, KIND)) == []
    load(spark, stored, 1, at(1, 5, 2), at(1, 9, equipment_id="E2"))  # late, to hours loaded before
    assert hours(load_changed_hours(spark, stored, datetime(2026, 1, 3, 13), KIND)) == [(1, 5), (1, 9), (3, 12)]
    assert facts(spark, stored) == [(1, 5, 3), (1, 9, 1), (2, 7, 1), (3, 12, 1)]
    # written again with other rows: hours that it held before are loaded as well, and emptied
    load(spark, stored, 1, at(2, 8))
    assert hours(load_changed_hours(spark, stored, datetime(2026, 1, 4), KIND)) == [(1, 5), (1, 9), (2, 8)]
    assert facts(spark, stored) == [(1, 5, 2), (2, 7, 1), (2, 8, 1), (3, 12, 1)]
    whole = Tables(workspace(spark, "whole"))
    load(spark, whole, 0, at(1, 5), at(1, 5, 1), at(2, 7), at(3, 12), at(2, 8))
    load_hours(spark, whole, datetime(2026, 1, 1), datetime(2026, 1, 4), KIND)
    assert facts(spark, whole) == facts(spark, stored)


def test_untouched_days_are_not_read(spark, monkeypatch):
    stored, end, read = Tables(workspace(spark, "days")), datetime(2026, 2, 1), []
    load(spark, stored, 0, *[at(day, 5) for day in range(1, 11)])
    load_changed_hours(spark, stored, end, KIND)
    load(spark, stored, 1, at(4, 5, 3))
    healthy = tables.upsert_fact

    def seen(df, path, **options):
        read.extend(path for path in df.inputFiles() if "event_date=" in path)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "event_date" in plan.split("PartitionFilters")[1]
        return healthy(df, path, **options)

    monkeypatch.setattr(tables, "upsert_fact", seen)
    before = {f: f for f in spark.read.parquet(stored.fact(ELEVATOR)).inputFiles()}
    assert hours(load_changed_hours(spark, stored, end, KIND)) == [(4, 5)]
    after = set(spark.read.parquet(stored.fact(ELEVATOR)).inputFiles())
    assert {f.split("date_key=")[1][:8] for f in set(before) - after} == {"20260104"}
    assert read and facts(spark, stored)[3] == (4, 5, 2)


def test_merged_batches_and_batches_without_rows(spark):
    stored, end = Tables(workspace(spark, "merged")), datetime(2027, 1, 1)
    load(spark, stored, 0, at(1, 5))
    load(spark, stored, 1, message(equipment_id=None))
    assert load_changed_hours(spark, stored, end, KIND).count() >= 2  # a clean hour and hours of rejection
    assert load_changed_hours(spark, stored, end, KIND).count() == 0
    load(spark, stored, 2, at(1, 6))
    merge_batches(spark, stored, before=3, kinds=KIND)
    assert hours(load_changed_hours(spark, stored, end, KIND)) == [(1, 5), (1, 6)]
    assert load_changed_hours(spark, stored, end, KIND).count() == 0
    assert facts(spark, stored) == [(1, 5, 1), (1, 6, 1)]
    rejected = tables.read_rejected_fact(spark, stored.rejected_fact)
    assert [r.rejected_count for r in rejected.collect()] == [1]
    assert ledger(stored).before(spark).filter("NOT loaded").count() == 0


def test_empty_table_has_no_hours(spark):
    stored = Tables(workspace(spark, "none"))
    assert load_changed_hours(spark, stored, datetime(2026, 1, 1), KIND).collect() == []


class Replay:
    def __init__(self, spark, schema, build, rocks=False):
        self.spark, self.home, self.schema = spark, workspace(spark, "replay"), schema
        self.build, self.rocks = build, rocks

    def send(self, *rows):
        text = self.schema.replace("ts timestamp", "ts string")
        frame = self.spark.createDataFrame(list(rows), text).withColumn("ts", F.to_timestamp("ts"))
        frame.coalesce(1).write.mode("append").parquet(f"{self.home}/in")
        source = self.build(self.spark.readStream.schema(self.schema).parquet(f"{self.home}/in"))
        writer = source.writeStream.format("parquet").option("checkpointLocation", f"{self.home}/checkpoint")
        with rocksdb(self.spark) if self.rocks else contextlib.nullcontext():
            query = writer.option("path", f"{self.home}/out").trigger(**ONCE).start()
        query.awaitTermination()
        return self.spark.read.parquet(f"{self.home}/out")


ROWS = "id string, ts timestamp, seq bigint, v double"


def test_late_readings_take_their_place(spark):
    before = spark.conf.get(PROVIDER, None)
    initial = spark.createDataFrame([("a", 2.0, 4), ("gone", 1.0, 9)], "id string, last_value double, repeat_count bigint")
    build = lambda s: stuck_stream_ordered(s, ["id"], ["ts", "seq"], "v", "1 hour", threshold=3, initial=initial)
    feed = Replay(spark, ROWS, build, rocks=True)
    assert feed.send(("a", "2026-01-01 10:00:00", 1, 2.0), ("a", "2026-01-01 10:20:00", 3, 3.0), ("b", "2026-01-01 10:00:00", 4, 5.0), ("b", "2026-01-01 10:10:00", 5, None), (None, "2026-01-01 10:00:00", 6, 5.0)).count() == 0
    feed.send(("a", "2026-01-01 10:10:00", 2, 3.0), ("b", "2026-01-01 12:00:00", 7, 0.0))
    got = feed.send(("a", "2026-01-01 10:50:00", 8, 3.0), ("a", "2026-01-01 11:30:00", 9, 3.0), ("end", "2026-02-01 00:00:00", 10, 0.0))
    rows = sorted((r.id, r.seq, r.run_length, r.is_stuck) for r in got.collect())
    # the first goes on from the state of before; seq 8 came when its time had passed
    assert rows == [("a", 1, 5, True), ("a", 2, 1, False), ("a", 3, 2, False), ("a", 9, 3, True), ("b", 4, 1, False), ("b", 7, 1, False)]
    assert spark.conf.get(PROVIDER, None) == before


def test_silent_keys_lose_their_state(spark):
    build = lambda s: stuck_stream_ordered(s, ["id"], ["ts", "seq"], "v", "1 hour", threshold=2, retire=7200)
    feed = Replay(spark, ROWS, build, rocks=True)
    feed.send(("a", "2026-01-01 10:00:00", 1, 2.0))
    feed.send(("end", "2026-01-01 12:00:00", 2, 0.0))
    feed.send(("end", "2026-01-01 18:00:00", 3, 0.0))
    feed.send(("a", "2026-01-01 19:00:00", 4, 2.0), ("end", "2026-01-02 18:00:00", 5, 0.0))
    got = feed.send(("end", "2026-01-03 18:00:00", 6, 0.0))
    assert {r.seq: r.run_length for r in got.filter("id = 'a'").collect()} == {1: 1, 4: 1}


def test_timers_of_one_batch_read_a_key_once():
    class State:
        def __init__(self):
            self.rows, self.reads = [], 0

        def get(self):
            self.reads += 1
            return iter(self.rows)

        def put(self, rows):
            self.rows = rows

        def appendList(self, rows):  # noqa: N802
            self.rows = self.rows + rows

    class Run(State):
        def __init__(self):
            self.row, self.reads = None, 0

        def get(self):
            self.reads += 1
            return self.row

        def update(self, row):
            self.row = row

        def exists(self):
            self.reads += 1
            return self.row is not None

    waiting, run = State(), Run()
    handle = SimpleNamespace(getListState=lambda *_: waiting, getValueState=lambda *_: run, registerTimer=lambda _: None)
    columns = struct_of("id STRING, ts BIGINT, v DOUBLE")
    task = OrderedRuns(columns, "ts", ["ts"], "v", 2, 1e-9, 10**9)
    task.init(handle)
    second = 1_000_000
    list(task.handleInputRows(("a",), iter([("a", i * second, 2.0, None) for i in range(5)]), None))
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 3000)
    out = [r for _ in range(3) for r in task.handleExpiredTimer(("a",), now, None)]
    assert [(r.ts // second, r.run_length, r.is_stuck) for r in out] == [(0, 1, False), (1, 2, True), (2, 3, True)]
    assert (waiting.reads, run.reads) == (1, 1)
    # rows that come later make the key's timers count again
    list(task.handleInputRows(("a",), iter([("a", 5 * second, 2.0, None)]), None))
    later = SimpleNamespace(getCurrentWatermarkInMs=lambda: 5000)
    assert [r.run_length for r in task.handleExpiredTimer(("a",), later, None)] == [4, 5]


@pytest.mark.parametrize("order", [1, -1])
def test_no_row_of_a_stream_is_lost(spark, order):
    feed = Replay(spark, ROWS, lambda s: admit(s, ["id"], "ts", "1 hour"))
    sent = [
        [("a", "2026-01-01 10:00:00", 1, 2.0), ("a", "2026-01-01 10:00:00", 2, 2.0), ("b", "2026-01-01 10:00:00", 3, None), (None, "2026-01-01 10:00:00", 4, 1.0)],
        [("a", "2026-01-01 10:00:00", 5, 2.0), ("a", "2026-01-01 09:30:00", 6, 2.0), ("a", "2026-01-01 12:00:00", 7, 2.0), ("a", None, 8, 2.0)],
        [("a", "2026-01-01 10:59:59", 9, 2.0), ("a", "2026-01-01 11:00:00", 10, 2.0), ("b", "2026-01-01 10:00:00", 11, 2.0), ("c", "2026-01-01 12:00:00", 12, 2.0)],
    ]
    for rows in sent:
        got = feed.send(*rows[::order])
    verdicts = {r.seq: r.verdict for r in got.collect()}
    copy = {1: 2, -1: 1}[order]  # of a batch's copies the first stays
    assert set(verdicts) == set(range(1, 13)) and got.count() == 12
    assert {k: v for k, v in verdicts.items() if v} == {copy: "doublon", 5: "doublon", 9: "en_retard", 11: "en_retard"}
    assert got.filter("seq = 3").first().v is None


def test_open_hours_are_replaced_until_they_close(spark):
    home, schema = workspace(spark, "open"), "equipment_id string, event_timestamp timestamp, alarm string, " + ", ".join(f"{m} double" for m in [*ELEVATOR.measures, ELEVATOR.counter])

    def send(*rows):
        values = [(e, t, "NONE", *[float(x)] * (len(ELEVATOR.measures) + 1)) for e, t, x in rows]
        frame = spark.createDataFrame(values, schema.replace("event_timestamp timestamp", "event_timestamp string"))
        frame.withColumn("event_timestamp", F.to_timestamp("event_timestamp")).coalesce(1).write.mode("append").parquet(f"{home}/in")
        start_hourly_stream(spark.readStream.schema(schema).parquet(f"{home}/in"), ELEVATOR, f"{home}/hours", f"{home}/checkpoint", trigger=ONCE).awaitTermination()
        rows = hourly_now(spark, f"{home}/hours", ELEVATOR).collect()
        return sorted((r.equipment_id, r.hour_key, r.measurement_count, r.provisional) for r in rows)

    assert hourly_now(spark, f"{home}/hours", ELEVATOR) is None
    assert send(("a", "2026-01-01 10:00:00", 1), ("b", "2026-01-01 10:05:00", 1)) == [("a", 10, 1, True), ("b", 10, 1, True)]
    assert send(("a", "2026-01-01 10:30:00", 2), ("a", "2026-01-01 11:30:00", 2)) == [("a", 10, 2, True), ("a", 11, 1, True), ("b", 10, 1, True)]
    closed = send(("a", "2026-01-01 12:00:00", 3))
    assert closed == [("a", 10, 2, False), ("a", 11, 1, True), ("a", 12, 1, True), ("b", 10, 1, False)]
    log = hourly_log(f"{home}/hours", ELEVATOR)
    last = log.versions(spark, "delta")[-1]
    changed = spark.read.parquet(f"{home}/hours/part=delta/version={last}")
    assert changed.count() == 1  # a batch writes the hours that it changed

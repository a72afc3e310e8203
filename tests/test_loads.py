"""State over loads, newest-day search, import by header, raw ingest and publishing."""

import os
from datetime import datetime

import pytest
from helpers import elevator_messages, message, reading
from pyspark.sql import functions as F

from quayside.catalogue import ELEVATOR
from quayside.operators.stuck import stuck_runs
from quayside.plans import serving
from quayside.plans.etl import Tables, clean_to_tables, ingest_files, loaded_state, raw_messages
from quayside.session import workspace
from quayside.sinks import tables
from quayside.sinks.state import StuckState
from quayside.sources import raw
from quayside.sources.topics import stream_source
from quayside.streaming.clean import start_clean_stream
from quayside.streaming.state import stuck_stream

AS_OF = datetime(2026, 1, 5, 12)


def files_below(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_runs_go_on_over_loads(spark):
    stored = Tables(workspace(spark, "loads"))
    for number in range(3):
        rows = [reading(number * 3 + i, 4.0) for i in range(3)]
        clean_to_tables(elevator_messages(spark, rows, start=number * 3), stored, number)

    def stuck():
        rejected = tables.read_rejected(spark, stored.rejected)
        return sorted(r[0] for r in rejected.select(F.second("event_timestamp")).collect())

    assert stuck() == [4, 5, 6, 7, 8]
    clean_to_tables(elevator_messages(spark, [reading(3 + i, 4.0) for i in range(3)], start=3), stored, 1)
    assert stuck() == [4, 5, 6, 7, 8]  # a repeated load starts from the same state


def states(spark, rows):
    return spark.createDataFrame(rows, "equipment_type string, equipment_id string, last_value double, repeat_count bigint")


def counts(state, spark, version=None, only=None):
    rows = state.before(spark, version, only)
    return None if rows is None else {r.equipment_id: r.repeat_count for r in rows.collect()}


def test_a_batch_writes_its_own_keys_in_one_file(spark):
    stored = Tables(workspace(spark, "deltas"))
    first = [message(equipment_id=f"E{i}") for i in range(300)]
    clean_to_tables(elevator_messages(spark, first), stored, 0)
    before = files_below(stored.path("stuck_state"))
    assert len(before) == 1  # however many keys
    clean_to_tables(elevator_messages(spark, [message(equipment_id="E3")], start=300), stored, 1)
    new = files_below(stored.path("stuck_state")) - before
    assert len(new) == 1 and spark.read.parquet(*new).count() == 1
    assert sum(loaded_state(spark, stored).select("repeat_count").toPandas().repeat_count) == 301


def test_state_of_snapshots_and_deltas(spark):
    state = StuckState(workspace(spark, "log"), every=3)
    assert counts(state, spark) is None and counts(state, spark, 7) is None
    for version in (0, 1, 4, 5, 6, 9):
        state.write(states(spark, [("elevator", "E", 1.0, version), ("elevator", f"E{version}", None, -version)]), version)
    assert state.versions(spark, "snapshot") == [4, 9] and state.versions(spark, "delta") == [0, 1, 4, 5, 6, 9]
    assert counts(state, spark, 0) is None and counts(state, spark, 1) == {"E": 0, "E0": 0}
    assert counts(state, spark, 6) == {"E": 5, "E0": 0, "E1": -1, "E4": -4, "E5": -5}
    assert counts(state, spark) == {"E": 9, "E0": 0, "E1": -1, "E4": -4, "E5": -5, "E6": -6, "E9": -9}
    assert counts(state, spark, 6, states(spark, [("elevator", "E4", 0.0, 0), ("rmg", "E", 0.0, 0)])) == {"E4": -4}
    # what is read: one snapshot and the deltas after it
    read = {f.rsplit("/", 2)[-2] for f in state.before(spark, 7).inputFiles()}
    assert read == {"version=4", "version=5", "version=6"}
    # a repeated batch replaces its own rows, and snapshots that hold the old ones go
    state.write(states(spark, [("elevator", "E", 1.0, 50)]), 5)
    assert state.versions(spark, "snapshot") == [4]
    assert counts(state, spark, 6) == {"E": 50, "E0": 0, "E1": -1, "E4": -4}
    assert counts(state, spark) == {"E": 9, "E0": 0, "E1": -1, "E4": -4, "E6": -6, "E9": -9}
    # a folder that was not finished is not read
    os.remove(f"{state.path.removeprefix('file:')}/part=snapshot/version=4/_SUCCESS")
    assert counts(state, spark, 6) == {"E": 50, "E0": 0, "E1": -1, "E4": -4}


def test_state_forgets_what_nobody_reads(spark):
    state = StuckState(workspace(spark, "state"), every=2)
    for version in range(6):
        state.write(states(spark, [("elevator", "E1", 1.0, version)]), version)
    state.forget(spark, 5)
    assert (state.versions(spark, "snapshot"), state.versions(spark, "delta")) == ([3, 5], [4, 5])
    assert counts(state, spark, 5) == {"E1": 4}


def test_stream_begins_where_loads_ended(spark):
    stored, home = Tables(workspace(spark, "loads")), workspace(spark, "after-loads")
    clean_to_tables(elevator_messages(spark, [reading(i, 4.0) for i in range(3)]), stored, 0)
    for part in range(2):
        rows = [reading(3 + 2 * part + i, 4.0) for i in range(2)]
        elevator_messages(spark, rows, start=10 * (part + 1)).coalesce(1).write.mode("append").parquet(f"{home}/inbox")
        query = start_clean_stream(
            stream_source(spark, fmt="parquet", path=f"{home}/inbox"),
            clean_path=stored.clean, rejected_path=stored.rejected, checkpoint=f"{home}/checkpoint",
            trigger={"availableNow": True}, begin_from=loaded_state(spark, stored),
        )
        query.awaitTermination()
    rejected = tables.read_rejected(spark, stored.rejected)
    assert sorted(r[0] for r in rejected.select(F.second("event_timestamp")).collect()) == [4, 5, 6]
    assert loaded_state(spark, stored).first().repeat_count == 3  # the loads' state is their own


def test_empty_micro_batch_writes_nothing(spark):
    home = workspace(spark, "empty")
    elevator_messages(spark, [message()], topic="unknown").write.parquet(f"{home}/inbox")
    query = start_clean_stream(
        stream_source(spark, fmt="parquet", path=f"{home}/inbox"),
        clean_path=f"{home}/clean",
        rejected_path=f"{home}/rejected",
        checkpoint=f"{home}/checkpoint",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    assert not os.path.exists(f"{home}/clean") and not os.path.exists(f"{home}/rejected")


def test_stream_and_batch_agree_on_nulls_and_nan(spark):
    nan = float("nan")
    cells = [("A", v) for v in (2.0, 2.0, nan, 2.0, 2.0, 2.0, None, 2.0, 2.0)] + [(None, 2.0)] * 6
    rows = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(cells)], "k string, at int, v double")
    rows = rows.withColumn("at", F.timestamp_seconds("at"))
    home = workspace(spark, "nan")
    rows.write.parquet(f"{home}/in")
    source = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
    query = (
        stuck_stream(source, ["k"], ["at"], "v")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{home}/checkpoint")
        .option("path", f"{home}/out")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

    def plain(df):
        return sorted(map(str, df.select("at", "k", "v", "run_length", "is_stuck").collect()))

    batch = stuck_runs(rows, ["k"], ["at"], "v")
    assert plain(spark.read.parquet(f"{home}/out")) == plain(batch)
    assert [r.run_length for r in batch.filter("k = 'A'").orderBy("at").collect()] == [1, 2, 1, 1, 2, 3, None, 4, 5]


@pytest.fixture(scope="module")
def days(spark):
    """Forty days of clean rows and rejects, one load."""
    stored = Tables(workspace(spark, "days"))
    rows = [
        message(equipment_id=f"E{d % 3}", timestamp=f"2026-{1 + d // 28:02d}-{1 + d % 28:02d}T10:00:{s:02d}", speed=s % 4)
        for d in range(40)
        for s in range(3)
    ]
    clean_to_tables(elevator_messages(spark, rows), stored, 0)
    return stored


@pytest.mark.parametrize("equipment_id", [None, "E1", "nobody"])
@pytest.mark.parametrize("limit", [1, 3, 7, 50, 5000])
def test_newest_days_hold_the_newest_rows(spark, days, equipment_id, limit):
    clean = tables.read_clean(spark, days.clean, ELEVATOR)
    plain = serving.latest(clean, equipment_id, limit)
    pruned = serving.latest(clean, equipment_id, limit, day_col="event_date")
    assert pruned.collect() == plain.collect()
    if limit == 1 and equipment_id is None:
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_newest_hours_of_a_stored_fact(spark):
    path = workspace(spark, "facts")
    rows = [(e, 20260101 + d, h, d + e, float(h)) for d in range(20) for h in range(3) for e in (1, 2)]
    fact = spark.createDataFrame(rows, "equipment_key bigint, date_key int, hour_key int, measurement_count bigint, avg_speed double")
    tables.upsert_fact(fact, path)
    stored = spark.read.parquet(path)
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "equipment_key bigint, equipment_id string")
    for one in (None, "B", "nobody"):
        for hours in (1, 4, 70):
            plain = serving.hourly(fact, dim, one, hours).select("date_key", "hour_key", "measurement_count")
            pruned = serving.hourly(stored, dim, one, hours, day_col="date_key")
            assert pruned.select(*plain.columns).collect() == plain.collect()


def test_upserts_read_the_days_they_touch(spark):
    path = workspace(spark, "raw")
    rows = [("elevator", "E1", f"2026-01-0{d}", f"2026-01-0{d} 00:00:00", "x", d) for d in range(1, 6)]
    new = spark.createDataFrame(rows, "equipment_type string, equipment_id string, day_bucket string, timestamp string, state string, seq bigint")
    new = new.withColumn("timestamp", F.to_timestamp("timestamp"))
    tables.upsert_raw_table(new, path, "seq")
    before = files_below(path)
    tables.upsert_raw_table(new.filter("seq = 3").withColumns({"state": F.lit("y"), "seq": F.lit(9).cast("bigint")}), path, "seq")
    changed = before ^ files_below(path)
    assert changed and all("day_bucket=2026-01-03" in f for f in changed)
    tables.upsert_raw_table(new.limit(0), path, "seq")
    stored = raw.scan_raw(spark, path, ELEVATOR).orderBy("day_bucket").collect()
    assert [r.state for r in stored] == ["x", "x", "y", "x", "x"] and stored[0].day_bucket == "2026-01-01"


def sheets(spark, tmp_path):
    (tmp_path / "a.csv").write_text("equipment_id,type,speed\nE1,ELEVATOR,3\n,,\nE1,ELEVATOR,4\n")
    (tmp_path / "b c.csv").write_text("\ntype,timestamp,equipment_id\nELEVATOR,2026-01-02 03:04:05,E2\nBOAT,,E3\nELEVATOR,soon,E4\n")
    (tmp_path / "d.csv").write_text("equipment_id,type,speed\nE5,ELEVATOR,\n")
    return str(tmp_path)


def test_each_sheet_has_its_own_header(spark, tmp_path):
    rows = raw.drop_blank_rows(raw.import_folder(spark, sheets(spark, tmp_path)))
    found = {tuple(r) for r in rows.select("equipment_id", "type", "speed", "timestamp").collect()}
    assert found == {
        ("E1", "ELEVATOR", "3", None),
        ("E1", "ELEVATOR", "4", None),
        ("E2", "ELEVATOR", None, "2026-01-02 03:04:05"),
        ("E3", "BOAT", None, None),
        ("E4", "ELEVATOR", None, "soon"),
        ("E5", "ELEVATOR", None, None),
    }


def test_ingest_then_publish(spark, tmp_path):
    stored = Tables(workspace(spark, "ingest"))
    for load in (0, 0, 1):  # a load that is repeated changes nothing
        ingest_files(spark, sheets(spark, tmp_path), stored, load, AS_OF)
    rows = raw.scan_raw(spark, stored.raw, ELEVATOR).select("equipment_id", "day_bucket", "speed").collect()
    assert sorted(map(tuple, rows), key=str) == [("E1", "2026-01-05", "4"), ("E2", "2026-01-02", None), ("E5", "2026-01-05", None)]
    rejected = spark.read.parquet(stored.rejected_import).filter("load_id = 1")
    assert sorted(r.reject_reason for r in rejected.collect()) == ["timestamp_invalide", "type_inconnu"]
    sent = {(r.topic, r.key): r.value for r in raw_messages(spark, stored, [ELEVATOR]).collect()}
    assert set(sent) == {("elevator_data", k) for k in ("E1", "E2", "E5")}
    assert '"timestamp":"2026-01-02T03:04:05.000000"' in sent["elevator_data", "E2"]
    assert '"speed":4.0' in sent["elevator_data", "E1"]

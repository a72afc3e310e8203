"""What the physical plans must look like for the engine to scale."""

from datetime import date, datetime

from helpers import elevator_messages, message

from quayside.bindings.frames import SHIPMENT, shipments, supplier_dim
from quayside.catalogue import ELEVATOR
from quayside.operators.dedupe import dedupe_first
from quayside.operators.quality import split_valid, with_reject_reason
from quayside.plans import serving, warehouse
from quayside.plans.cleaning import flag_stuck, validate_messages
from quayside.sinks import tables
from quayside.sources.topics import parse_payload


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payload_is_parsed_once(spark):
    messages = elevator_messages(spark, [message()])
    valid, rejected = split_valid(with_reject_reason(parse_payload(messages, ELEVATOR), ELEVATOR))
    for df in (valid, rejected, validate_messages(messages).filter("reject_reason IS NULL")):
        assert physical(df).count("from_json") == 1
        assert "Exchange" not in physical(df)


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "x")], "k int, seq int, v string")
    plan = physical(dedupe_first(df, ["k"], ["seq"]))
    assert plan.index("partial_min_by") > plan.index("Exchange")
    assert plan.count("Exchange") == 1


def test_rows_are_dealt_once_for_copies_runs_and_state(spark):
    valid, _ = split_valid(validate_messages(elevator_messages(spark, [message()])))
    prior = spark.createDataFrame([], "equipment_type string, equipment_id string, last_value double, repeat_count bigint")
    assert physical(flag_stuck(valid, rows_per_piece=None)).count("Exchange") == 1
    plan = physical(flag_stuck(valid, prior=prior, rows_per_piece=None))
    assert sum("Exchange hashpartitioning(equipment_type" in line for line in plan.splitlines()) <= 2  # one is the state's


def test_fact_reads_only_its_columns_and_aggregates_before_joining(spark, sf_dir):
    by_id = warehouse.hourly_by_id(shipments(spark, sf_dir), SHIPMENT)
    fact = warehouse.with_equipment_key(by_id, supplier_dim(spark, sf_dir))
    plan = physical(fact)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("l_quantity" in s and "l_comment" not in s and "l_tax" not in s for s in scans)
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join" in line)
    partial = next(i for i, line in enumerate(plan.splitlines()) if "partial_avg" in line)
    assert join < partial


def test_hour_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = validate_messages(elevator_messages(spark, [message()]))
    tables.write_clean(tables.clean_rows(rows), path, 0)
    clean = tables.read_clean(spark, path, ELEVATOR)
    plan = physical(warehouse.hour_window(clean, "event_timestamp", datetime(2026, 1, 1)))
    partition_filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "equipment_type" in partition_filters and "event_date" in partition_filters
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(event_timestamp" in pushed
    assert clean.first().event_date == date(2026, 1, 1)


def test_last_hours_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(20260101, 1, "t", "r", 1)]
    df = spark.createDataFrame(rows, "date_key int, hour_key int, topic string, reject_reason string, rejected_count bigint")
    tables.upsert_fact(df, path)
    stored = spark.read.parquet(path)
    plan = physical(serving.last_hours_filter(stored, 24, datetime(2026, 1, 1, 2)))
    assert "date_key" in plan[plan.index("PartitionFilters") :].split("]")[0]


def test_latest_is_a_top_k(spark, sf_dir):
    rows = shipments(spark, sf_dir)
    assert "TakeOrderedAndProject" in physical(serving.latest(rows, limit=10))


def test_one_pass_profile(spark):
    from quayside.operators.counts import topic_profile

    df = spark.createDataFrame([("t", "a")], "topic string, equipment_id string")
    assert "Expand" not in physical(topic_profile(df))


def test_new_ids_are_not_numbered_in_one_task(spark):
    from quayside.operators.merge import count_off

    ids = spark.createDataFrame([("a",)], "equipment_id string")
    plan = physical(count_off(ids, "equipment_id", "equipment_key", None))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("row_number" in w and "_bucket" in w for w in windows)

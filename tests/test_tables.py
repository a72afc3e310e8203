"""Writes that must not lose what others wrote, nor keep what is gone."""

import glob
from datetime import datetime

import pytest
from helpers import elevator_messages, message
from pyspark.sql import functions as F

from quayside.plans.etl import Tables, clean_to_tables, drop_merged, merge_batches
from quayside.plans.warehouse import rejected_hourly
from quayside.session import workspace
from quayside.sinks import batches, tables
from quayside.streaming.clean import start_clean_stream


def ids(spark, stored):
    clean = [r.equipment_id for r in tables.read_clean(spark, stored.clean, "elevator").collect()]
    return sorted(clean), tables.read_rejected(spark, stored.rejected).count()


def load(spark, stored, name, batch_id):
    rows = elevator_messages(spark, [message(equipment_id=name), message(equipment_id=name, speed=-1e9)])
    clean_to_tables(rows, stored, batch_id=batch_id)


def test_loads_and_streams_keep_each_others_rows(spark):
    stored = Tables(workspace(spark, "writers"))
    load(spark, stored, "A", 0)
    load(spark, stored, "B", 1)
    assert ids(spark, stored) == (["A", "B"], 2)
    load(spark, stored, "B", 1)  # the same load again replaces itself
    assert ids(spark, stored) == (["A", "B"], 2)
    for name in ("C", "D"):  # two streams, each of which begins at batch 0
        source = workspace(spark, "messages")
        elevator_messages(spark, [message(equipment_id=name)]).write.parquet(source)
        stream = spark.readStream.schema("topic string, key string, value string, offset bigint").parquet(source)
        query = start_clean_stream(
            stream, clean_path=stored.clean, rejected_path=stored.rejected, checkpoint=workspace(spark, "checkpoint"), trigger={"availableNow": True}
        )
        query.awaitTermination()
    assert ids(spark, stored) == (["A", "B", "C", "D"], 2)


def test_merged_batches_are_read_once(spark):
    stored = Tables(workspace(spark, "merges"))

    def files():
        return sum(len(glob.glob(f"{f.path}/*/*/*.parquet")) for f in batches.current(spark, stored.clean))

    for number, name in ((3, "D"), (4, "E"), (5, "F")):
        load(spark, stored, name, number)
    assert files() == 3
    merge_batches(spark, stored, before=5)
    assert ids(spark, stored) == (["D", "E", "F"], 3)  # though the merged folders are still there
    assert files() == 2  # one day of one kind: the merge's file and that of batch 5
    with pytest.raises(ValueError, match="has been merged"):
        load(spark, stored, "E", 4)
    load(spark, stored, "A", 0)  # below an earlier merge
    merge_batches(spark, stored, before=6)  # a single batch follows the merge: nothing to do
    load(spark, stored, "G", 6)
    merge_batches(spark, stored, before=7)
    assert ids(spark, stored) == (["A", "D", "E", "F", "G"], 5)
    drop_merged(spark, stored)
    assert ids(spark, stored) == (["A", "D", "E", "F", "G"], 5)
    assert files() == 3 == len(glob.glob(f"{stored.clean}/*/*/*/*/*.parquet"))


def test_a_merge_that_was_lost_half_way_is_not_read(spark):
    stored = Tables(workspace(spark, "lost-merge"))
    for number, name in enumerate("AB"):
        load(spark, stored, name, number)
    merge_batches(spark, stored, before=2)
    batches.remove(spark, f"{stored.clean}/writer=merged-batch-0/batch_id=1/_SUCCESS")
    assert ids(spark, stored) == (["A", "B"], 2)
    drop_merged(spark, stored)  # keeps the batches of the clean table, as their merge did not end
    merge_batches(spark, stored, before=2)
    assert ids(spark, stored) == (["A", "B"], 2)


def fact(spark, rows):
    return spark.createDataFrame(rows, "equipment_key bigint, date_key int, hour_key int, n bigint")


def test_reloaded_hours_that_became_empty_lose_their_facts(spark):
    path = workspace(spark, "fact")
    tables.upsert_fact(fact(spark, [(1, 20260101, 5, 1), (1, 20260102, 5, 2), (2, 20260102, 6, 3), (1, 20260103, 0, 4)]), path)

    def stored():
        schema = "equipment_key bigint, hour_key int, n bigint, date_key int"
        return sorted(r.n for r in spark.read.schema(schema).parquet(path).collect())

    day, nothing = datetime(2026, 1, 2), fact(spark, [])
    tables.upsert_fact(nothing, path, hours=(day.replace(hour=5), day.replace(hour=5)))
    assert stored() == [1, 3, 4]
    tables.upsert_fact(nothing, path, hours=(day, day.replace(hour=23)))
    assert stored() == [1, 4]
    tables.upsert_fact(nothing, path, hours=(datetime(2026, 1, 1), datetime(2026, 1, 3, 23)))
    assert stored() == []
    tables.upsert_fact(fact(spark, [(9, 20260102, 1, 7)]), path, hours=(day, day.replace(hour=23)))
    assert stored() == [7]


def test_rejected_hours_read_their_days_only(spark):
    stored = Tables(workspace(spark, "pruned"))
    load(spark, stored, "A", 0)
    rows = rejected_hourly(tables.read_rejected(spark, stored.rejected), datetime(2026, 1, 1, 3))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "rejected_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows.agg(F.sum("rejected_count")).first()[0] is None

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quayside.catalogue import ELEVATOR, KINDS, STS
from quayside.functions import time
from quayside.operators.counts import batch_counts, observe_counts, reject_rate
from quayside.operators.merge import count_off, insert_if_absent, split_on_keys, upsert_by_key
from quayside.plans import serving, warehouse
from quayside.sinks import tables


def clean(spark, rows):
    """(id, time, speed, alarm) elevator rows."""
    df = spark.createDataFrame(
        [(i, datetime.fromisoformat(t), float(s), a) for i, t, s, a in rows],
        "equipment_id string, event_timestamp timestamp, speed double, alarm string",
    )
    for name in ("load_value", "temperature", "energy"):
        df = df.withColumn(name, F.lit(1.0))
    return df.withColumn("engine_hours", F.col("speed") + 0.5)


def dim(spark, *ids):
    return spark.createDataFrame([(n + 1, i) for n, i in enumerate(ids)], "equipment_key bigint, equipment_id string")


def test_hour_is_half_open(spark):
    rows = clean(spark, [
        ("A", "2026-01-01T08:00:00", 1, "NONE"),
        ("A", "2026-01-01T08:59:59.999999", 2, "NONE"),
        ("A", "2026-01-01T09:00:00", 3, "NONE"),
        ("A", "2026-01-01T07:59:59", 4, "NONE"),
    ])
    fact = warehouse.hourly_fact(rows, dim(spark, "A"), "elevator", datetime(2026, 1, 1, 9, 30))
    (row,) = fact.collect()
    assert (row.date_key, row.hour_key, row.measurement_count) == (20260101, 8, 2)
    assert (row.min_speed, row.avg_speed, row.max_speed, row.max_engine_hours) == (1.0, 1.5, 2.0, 2.5)


def test_target_hour_across_the_year(spark):
    rows = clean(spark, [("A", "2025-12-31T23:10:00", 1, "NONE")])
    (row,) = warehouse.hourly_fact(rows, dim(spark, "A"), ELEVATOR, datetime(2026, 1, 1, 0, 20)).collect()
    assert (row.date_key, row.hour_key) == (20251231, 23)
    assert warehouse.target_date(datetime(2026, 1, 1, 0, 20)) == date(2025, 12, 31)


def test_alarms_are_counted_without_nulls(spark):
    rows = clean(spark, [("A", f"2026-01-01T08:00:0{i}", 1, a) for i, a in enumerate(["NONE", None, "OVERHEAT"])])
    (row,) = warehouse.hourly_fact(rows, dim(spark, "A"), ELEVATOR, datetime(2026, 1, 1, 9)).collect()
    assert (row.measurement_count, row.alarm_count) == (3, 1)
    assert STS.incident.count_name == "fault_count" and STS.counter is None


def test_unknown_equipment_drops_out(spark):
    rows = clean(spark, [("A", "2026-01-01T08:00:00", 1, None), ("B", "2026-01-01T08:00:00", 1, None)])
    fact = warehouse.hourly_fact(rows, dim(spark, "A"), ELEVATOR, datetime(2026, 1, 1, 9))
    assert [r.equipment_key for r in fact.collect()] == [1]


def test_fact_columns_follow_the_catalogue(spark):
    for kind in KINDS:
        names = [f"{f}_{m}" for m in kind.measures for f in ("avg", "min", "max")]
        schema = ", ".join(f"{c} double" for c in kind.numeric_fields)
        empty = spark.createDataFrame([], f"equipment_id string, event_timestamp timestamp, alarm string, status string, {schema}")
        columns = warehouse.hourly_by_id(empty, kind).columns
        extra = [] if kind.counter is None else ["max_engine_hours"]
        assert columns[3:] == ["measurement_count", kind.incident.count_name, *names, *extra]


def test_hour_built_twice_keeps_the_second(spark, tmp_path):
    path, d = str(tmp_path / "fact"), dim(spark, "A", "B")
    first = clean(spark, [("A", "2026-01-01T08:00:00", 1, None), ("B", "2026-01-01T07:00:00", 1, None)])
    more = clean(spark, [("A", "2026-01-01T08:00:00", 1, None), ("A", "2026-01-01T08:10:00", 3, None)])
    tables.upsert_fact(warehouse.hourly_backfill(first, d, ELEVATOR, datetime(2026, 1, 1, 7), datetime(2026, 1, 1, 8)), path)
    for _ in range(2):
        tables.upsert_fact(warehouse.hourly_fact(more, d, ELEVATOR, datetime(2026, 1, 1, 9)), path)
    rows = spark.read.parquet(path).orderBy("hour_key").collect()
    assert [(r.hour_key, r.measurement_count) for r in rows] == [(7, 1), (8, 2)]


def test_reloaded_hours_lose_rows_that_are_gone(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "equipment_key bigint, n int, date_key int, hour_key int"
    old = spark.createDataFrame([(k, 1, 20260101, h) for k in (1, 2) for h in (7, 8, 9)], schema)
    tables.upsert_fact(old, path)
    new = spark.createDataFrame([(1, 2, 20260101, 8)], schema)
    tables.upsert_fact(new, path, hours=(datetime(2026, 1, 1, 8), datetime(2026, 1, 1, 9)))
    rows = spark.read.parquet(path).select("equipment_key", "n", "hour_key").collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 7), (1, 2, 8), (2, 1, 7)]


def test_upsert_by_key_keeps_other_rows_of_the_hour(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "equipment_key bigint, n int, date_key int, hour_key int"
    old = spark.createDataFrame([(1, 10, 20260101, 8), (2, 20, 20260101, 8), (1, 30, 20260101, 9)], schema)
    new = spark.createDataFrame([(2, 21, 20260101, 8), (3, 31, 20260101, 8)], schema)
    tables.upsert_fact(old, path, mode="key")
    tables.upsert_fact(new, path, mode="key")
    rows = spark.read.parquet(path).select("equipment_key", "n", "hour_key").collect()
    assert sorted(map(tuple, rows)) == [(1, 10, 8), (1, 30, 9), (2, 21, 8), (3, 31, 8)]
    with pytest.raises(ValueError):
        tables.upsert_fact(new, path, mode="merge")


def test_calendar(spark):
    days = {r.full_date: r for r in warehouse.build_dim_date(spark, date(2026, 1, 1), date(2027, 1, 1)).collect()}
    assert len(days) == 366
    sunday, newyear = days[date(2026, 1, 4)], days[date(2027, 1, 1)]
    assert (sunday.date_key, sunday.day_of_week, sunday.is_weekend) == (20260104, 7, True)
    assert (newyear.week_of_year, newyear.month_name, newyear.is_weekend) == (53, "January", False)
    hours = warehouse.build_dim_hour(spark).orderBy("hour_key").collect()
    assert len(hours) == 24 and (hours[14].hour_label, hours[3].hour_label) == ("14h", "3h")


def test_shared_id_takes_the_first_kind(spark):
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "equipment_id string")
    by_kind = {"rmg": ids("X", "Y"), "elevator": ids("X", None), "tractor": ids("Z", "Y")}
    rows = warehouse.build_dim_equipment(by_kind).collect()
    assert {r.equipment_id: r.equipment_type for r in rows} == {"X": "ELEVATOR", "Y": "RMG", "Z": "TRACTOR"}
    assert sorted(r.equipment_key for r in rows) == [1, 2, 3]


def test_new_keys_follow_existing_ones(spark):
    existing = spark.createDataFrame([(7, "A")], "equipment_key bigint, equipment_id string")
    ids = spark.createDataFrame([(f"E{i}",) for i in range(500)], "equipment_id string")
    numbered = count_off(ids, "equipment_id", "equipment_key", existing)
    assert sorted(r.equipment_key for r in numbered.collect()) == list(range(8, 508))
    assert insert_if_absent(existing, existing, ["equipment_id"]).isEmpty()
    again = count_off(ids.repartition(3), "equipment_id", "equipment_key", existing)
    assert numbered.exceptAll(again).isEmpty()


def test_split_does_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,)], "k int")
    inside, outside = split_on_keys(rows, keys, ["k"])
    assert (inside.count(), outside.count()) == (2, 1)
    merged = upsert_by_key(rows.filter("k = 2").withColumn("v", F.lit("d")), rows, ["k"])
    assert sorted(r.v for r in merged.collect()) == ["a", "b", "d"]


def test_counts(spark):
    rows = spark.createDataFrame(
        [("t", None), ("t", "capteur_bloque"), ("u", "timestamp_manquant"), ("t", None)],
        "topic string, reject_reason string",
    )
    by_topic = {r.topic: (r.valid_count, r.rejected_count, r.stuck_count) for r in batch_counts(rows).collect()}
    assert by_topic == {"t": (2, 1, 1), "u": (0, 1, 0)}
    assert reject_rate(rows).first().reject_rate == 0.5
    assert observe_counts(rows, "figures").count() == 4


def fact(spark):
    rows = [(1, 20260101, 13, 1, 10.0), (2, 20260101, 13, 9, 20.0), (1, 20260101, 14, 2, 5.0)]
    df = spark.createDataFrame(rows, "equipment_key bigint, date_key int, hour_key int, measurement_count bigint, avg_speed double")
    return df.withColumns({"min_speed": F.col("avg_speed") - 1, "max_speed": F.col("avg_speed") + 1, "alarm_count": F.lit(1)})


def test_fleet_mean_of_means_and_weighted(spark):
    plain = serving.fleet(fact(spark)).filter("hour_key = 13").first()
    assert (plain.avg_speed, plain.min_speed, plain.max_speed) == (15.0, 9.0, 21.0)
    assert (plain.measurement_count, plain.alarm_count) == (10, 2)
    assert serving.fleet(fact(spark), weighted=True).filter("hour_key = 13").first().avg_speed == 19.0


def test_hourly_serving(spark):
    d = dim(spark, "A", "B")
    one = serving.hourly(fact(spark), d, "A", hours=1).collect()
    assert [(r.equipment_id, r.hour_key) for r in one] == [("A", 14)]
    assert [r.hour_key for r in serving.hourly(fact(spark), d, "all").collect()] == [13, 14]
    assert [r.hour_key for r in serving.hourly(fact(spark), d, hours=1).collect()] == [14]


def test_clamps():
    values = [serving.clamp(v, serving.LATEST_LIMIT) for v in (0, -5, 5000, "x", None, "7")]
    assert values == [1, 1, 1000, 100, 100, 7]


def test_functions_do_not_cap(spark):
    rows = clean(spark, [("A", f"2026-01-01T08:{n // 60:02d}:{n % 60:02d}", n, None) for n in range(1200)])
    assert serving.latest(rows, limit=1100).count() == 1100
    with pytest.raises(ValueError, match="1 or more"):
        serving.latest(rows, limit=0)


def test_latest_is_oldest_first(spark):
    rows = clean(spark, [(i, f"2026-01-01T08:00:0{n}", n, None) for n, i in enumerate("ABABA")])
    assert [r.speed for r in serving.latest(rows, limit=3).collect()] == [2.0, 3.0, 4.0]
    assert [r.speed for r in serving.latest(rows, "B").collect()] == [1.0, 3.0]
    assert serving.latest(rows, "all").count() == 5


def test_last_hours_of_one_day(spark):
    rows = [(20260101, h, "t", "r", 1) for h in range(24)] + [(20251231, 23, "t", "r", 5)]
    df = spark.createDataFrame(rows, "date_key int, hour_key int, topic string, reject_reason string, rejected_count bigint")
    as_of = datetime(2026, 1, 1, 14)
    hours = [r.hour_key for r in serving.last_hours_filter(df, 1, as_of).orderBy("hour_key").collect()]
    assert hours == [13, 14]
    assert serving.last_hours_filter(df, 1, as_of, legacy=True).count() == 24
    across = serving.last_hours_filter(df, 15, as_of)
    assert across.count() == 16 and across.filter("date_key = 20251231").count() == 1
    summary = serving.rejected_summary(df, 1, as_of=as_of)
    assert [tuple(r) for r in summary.collect()] == [("t", "r", 2)]
    assert serving.rejected_total(summary).first()[0] == 2
    assert serving.rejected_total(summary.filter("topic = 'none'")).first()[0] == 0


def test_monitor(spark):
    opened = []

    def table(kind):
        opened.append(kind.name)
        return clean(spark, [("A", "2026-01-01T08:00:00", 1, None)])

    rejected = spark.createDataFrame(
        [("t", "A", "{}", "r", datetime(2026, 1, 1, n)) for n in range(3)],
        "topic string, equipment_id string, raw_payload string, reject_reason string, rejected_at timestamp",
    )
    facts = warehouse.rejected_hourly(rejected, datetime(2026, 1, 1), datetime(2026, 1, 2))
    monitor = serving.Monitor(table, lambda k: fact(spark), dim(spark, "A"), rejected, facts)
    unknown = monitor.latest("boat")
    assert unknown.data is None and unknown.error == "unknown kind of equipment: boat"
    assert opened == []
    answer = monitor.latest("elevator", limit="x")
    assert answer.about["numeric_fields"] == ["speed", "load_value", "temperature", "energy", "engine_hours"]
    assert (answer.about["status_field"], answer.data.count(), opened) == ("alarm", 1, ["elevator"])
    assert [r[0] for r in monitor.equipment_ids("rmg").data.collect()] == ["A"]
    assert monitor.hourly("elevator", "A").data.count() == 2
    assert monitor.rejected_recent(2).data.first().rejected_at == datetime(2026, 1, 1, 2)
    assert monitor.rejected_summary(as_of=datetime(2026, 1, 1, 2)).about == {"hours": 24}
    assert [c["key"] for c in monitor.choices()] == [k.name for k in KINDS]


def test_rejections_are_dated_by_processing(spark):
    df = spark.createDataFrame(
        [("t", "r", datetime(2026, 1, 1, 8, 59)), ("t", "r", datetime(2026, 1, 1, 9))],
        "topic string, reject_reason string, rejected_at timestamp",
    )
    got = warehouse.rejected_hourly(df, time.target_hour(datetime(2026, 1, 1, 9, 5)))
    assert [tuple(r) for r in got.collect()] == [(20260101, 8, "t", "r", 1)]


def test_hours_from_messages_to_monitor(spark, tmp_path):
    from helpers import elevator_messages, reading

    from quayside.plans.etl import Tables, clean_to_tables, load_hours, load_last_hour, open_monitor

    stored = Tables(str(tmp_path))
    payloads = [reading(i * 60, 1 + i % 2, equipment_id=f"E{i % 2}") for i in range(59)]
    payloads += [reading(5, 9), reading(6, None)]
    for _ in range(2):
        clean_to_tables(elevator_messages(spark, payloads), stored, batch_id=0)
    load_last_hour(spark, stored, datetime(2026, 1, 1, 1, 10), [ELEVATOR])
    load_hours(spark, stored, datetime(2025, 12, 31, 22), datetime(2026, 1, 1, 3), [ELEVATOR])
    monitor = open_monitor(spark, stored, [ELEVATOR])
    assert [r[0] for r in monitor.equipment_ids("elevator").data.collect()] == ["E0", "E1"]
    (hour,) = monitor.hourly("elevator").data.collect()
    assert (hour.date_key, hour.hour_key, hour.measurement_count) == (20260101, 0, 8)
    assert monitor.latest("elevator", "E1", 2).data.count() == 2
    reasons = {r.reject_reason for r in monitor.rejected_recent(500).data.collect()}
    assert "valeur_hors_limites:speed" in reasons and "capteur_bloque" in reasons
    assert spark.read.parquet(stored.path("dim_equipment")).count() == 2
    assert spark.read.parquet(stored.path("dim_hour")).count() == 24
    assert spark.read.parquet(stored.path("dim_date")).count() == 2

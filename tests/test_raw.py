from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.catalogue import ELEVATOR, TRACTOR
from quayside.functions import text
from quayside.operators.merge import raw_upsert
from quayside.operators.publish import to_keyed_json
from quayside.plans import etl
from quayside.plans.cleaning import validate_messages
from quayside.session import workspace
from quayside.sinks import tables
from quayside.sources import raw
from quayside.streaming import ingest

AS_OF = datetime(2026, 1, 2, 3, 4, 5)


def test_import_of_a_sheet(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text(
        "equipment_id,type,timestamp,speed\n"
        "A,ELEVATOR,2026-01-01 10:00:00,1.5,surplus\n"
        ",,,\n"
        "B,RMG,,2\n"
        "C,BOAT,2026-01-01 10:00:00,3\n"
        "D,STS,soon,4\n"
    )
    df = raw.drop_blank_rows(raw.import_file(spark, str(sheet)))
    assert df.columns == ["equipment_id", "type", "timestamp", "speed"]
    known, unknown = raw.route_by_type(df)
    assert [r.equipment_id for r in unknown.collect()] == ["C"]
    assert {r.equipment_id: r.equipment_type for r in known.collect()} == {
        "A": "elevator", "B": "rmg", "D": "sts",
    }
    rows, rejected = raw.prepare_import(known, AS_OF)
    got = {r.equipment_id: (r.timestamp, r.day_bucket) for r in rows.collect()}
    assert got == {"A": (datetime(2026, 1, 1, 10), "2026-01-01"), "B": (AS_OF, "2026-01-02")}
    (bad,) = rejected.collect()
    assert (bad.timestamp, bad.reject_reason) == ("soon", "timestamp_invalide")


def test_text_and_back(spark):
    df = spark.createDataFrame(
        [("T1", 1.5, True, None), ("T2", None, False, 3.0)],
        "equipment_id string, speed double, container_attached boolean, energy double",
    )
    stored = raw.textify(df)
    assert [tuple(r) for r in stored.collect()] == [("T1", "1.5", "True", None), ("T2", None, "False", "3.0")]
    assert raw.infer_type(stored, TRACTOR).collect() == df.collect()


def test_loose_types(spark):
    cells = {
        "TRUE": ("bool", "true"), " false ": ("bool", "false"), "12": ("int", "12"),
        " -7 ": ("int", "-7"), "1_000": ("int", "1000"), "1.50": ("float", "1.5"), "1e3": ("float", "1000.0"),
        "nan": ("float", "NaN"), "abc": ("text", '"abc"'), "5f": ("text", '"5f"'),
        "0x10": ("text", '"0x10"'), "": ("text", '""'), 'say "x"': ("text", '"say \\"x\\""'), "1_": ("text", '"1_"'),
    }
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    got = df.select("cell", text.loose_type(F.col("cell")), text.loose_json(F.col("cell"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cells


def test_nulls_do_not_overwrite(spark):
    schema = "id string, a string, b string, seq bigint"
    old = raw_upsert(spark.createDataFrame([("x", "1", "1", 1), ("y", "1", None, 1)], schema), None, ["id"], "seq")
    new = spark.createDataFrame([("x", None, "2", 2), ("x", "3", None, 3), ("z", None, None, 2)], schema)
    rows = {r.id: (r.a, r.b, r.seq) for r in raw_upsert(new, old, ["id"], "seq").collect()}
    assert rows == {"x": ("3", "2", 3), "y": ("1", None, 1), "z": (None, None, 2)}


def raw_table(spark, rows):
    df = spark.createDataFrame(
        [(k, i, datetime.fromisoformat(t), s, n) for n, (k, i, t, s) in enumerate(rows)],
        "equipment_type string, equipment_id string, timestamp timestamp, speed string, seq bigint",
    )
    return raw.with_day_bucket(df)


def test_stored_history(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.upsert_raw_table(raw_table(spark, [
        ("elevator", "A", "2026-01-01T10:00:00", "1"),
        ("elevator", "A", "2026-01-02T10:00:00", "2"),
        ("tractor", "A", "2026-01-02T10:00:00", "9"),
    ]), path, "seq")
    later = raw_table(spark, [("elevator", "A", "2026-01-02T10:00:00", None), ("elevator", "A", "2026-01-02T11:00:00", "3")])
    tables.upsert_raw_table(later.withColumn("seq", F.col("seq") + 100), path, "seq")
    rows = raw.scan_raw(spark, path, ELEVATOR)
    assert rows.count() == 3
    found = raw.history(rows, "A", ["2026-01-02", "2026-01-05"])
    assert [(r.timestamp.hour, r.speed) for r in found.collect()] == [(11, "3"), (10, "2")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "day_bucket" in filters and "equipment_type" in filters


def test_published_messages_are_readable_again(spark):
    rows = spark.createDataFrame(
        [("A", datetime(2026, 1, 1, 10, 0, 0, 5), "1.5", "2026-01-01"), (None, datetime(2026, 1, 1), "2", "2026-01-01")],
        "equipment_id string, timestamp timestamp, speed string, day_bucket string",
    )
    sent = to_keyed_json(raw.infer_type(rows, ELEVATOR))
    (m,) = sent.collect()
    assert m.key == "A" and m.value == '{"equipment_id":"A","timestamp":"2026-01-01T10:00:00.000005","speed":1.5}'
    back = validate_messages(sent.withColumns({"topic": F.lit("elevator_data"), "offset": F.lit(0)})).first()
    assert (back.speed, back.event_timestamp) == (1.5, datetime(2026, 1, 1, 10, 0, 0, 5))


def test_sheets_are_taken_in_once(spark, tmp_path):
    """A batch that is lost after its rows were written is repeated without copies; the later sheet wins."""
    stored, inbox = etl.Tables(workspace(spark, "taken")), tmp_path / "inbox é"
    inbox.mkdir()

    def start():
        return ingest.start_ingest_stream(
            spark, str(inbox), stored, str(tmp_path / "checkpoint"), datetime(2026, 1, 5), [ELEVATOR], 1, {"availableNow": True}
        )

    def send(name, *rows):
        (inbox / name).write_text("equipment_id,type,timestamp,speed\n" + "\n".join(rows) + "\n")

    send("a.csv", "E1,ELEVATOR,2026-01-01 10:00:00,1", "E2,ELEVATOR,2026-01-01 10:00:00,2", "E3,OTHER,2026-01-01 10:00:00,3")
    start().awaitTermination()
    send("b b.csv", "E1,ELEVATOR,2026-01-01 10:00:00,7")
    whole, lost = ingest.ingest_files, []

    def fail(*args):
        whole(*args)
        lost.append(args[3])
        raise RuntimeError("lost")

    ingest.ingest_files = fail
    try:
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
    finally:
        ingest.ingest_files = whole
    start().awaitTermination()
    start().awaitTermination()  # nothing is new
    rows = {r.equipment_id: r.speed for r in spark.read.parquet(stored.raw).collect()}
    assert lost == [1] and rows == {"E1": "7", "E2": "2"}
    rejected = spark.read.parquet(stored.rejected_import)
    assert [(r.reject_reason, r.load_id) for r in rejected.collect()] == [("type_inconnu", 0)]

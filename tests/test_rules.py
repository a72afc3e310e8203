import pytest
from helpers import elevator_messages, message
from pyspark.sql import functions as F

from quayside import catalogue as cat
from quayside.catalogue import ELEVATOR, KINDS, find_kind, merged_schema
from quayside.operators.quality import (
    split_valid,
    to_clean_columns,
    to_rejected,
    to_rejected_mixed,
    union_rejects,
    violations,
    with_reject_reason,
)
from quayside.plans.cleaning import validate_messages
from quayside.sources.topics import parse_payload

CASES = [
    (message(), None),
    (message(equipment_id=None), "identifiant_manquant"),
    (message(equipment_id="  "), "identifiant_manquant"),
    (message(equipment_id=None, timestamp=None), "identifiant_manquant"),
    (message(timestamp=None), "timestamp_manquant"),
    (message(timestamp=""), "timestamp_manquant"),
    (message(timestamp="bad"), "timestamp_invalide"),
    (message(speed=None), "mesure_critique_manquante:speed"),
    (message(speed=None, energy=None, load=9999), "mesure_critique_manquante:speed,energy"),
    (message(speed=5.0), None),
    (message(load=0), None),
    (message(temperature=-20), None),
    (message(speed=5.01), "valeur_hors_limites:speed"),
    (message(energy=101, temperature=81, speed=-1), "valeur_hors_limites:speed,temperature,energy"),
    (message(engine_hours=100001), "valeur_hors_limites:engine_hours"),
    (message().replace('"speed": 1', '"speed": NaN'), "valeur_hors_limites:speed"),
    (message().replace('"speed": 1', '"speed": Infinity'), "valeur_hors_limites:speed"),
    (message(speed="1.5"), "mesure_critique_manquante:speed"),
    ("not json", "identifiant_manquant"),
    ("[]", "identifiant_manquant"),
    ("null", "identifiant_manquant"),
    (message()[:40], "identifiant_manquant"),
    (message(colour="blue", vibration=99), None),
]


@pytest.fixture(scope="module")
def messages(spark):
    return elevator_messages(spark, [payload for payload, _ in CASES]).cache()


def test_reasons_of_one_kind(spark, messages):
    rows = with_reject_reason(parse_payload(messages, ELEVATOR), ELEVATOR).orderBy("offset").collect()
    assert [r.reject_reason for r in rows] == [reason for _, reason in CASES]
    assert (rows[0].state, rows[0].alarm, rows[0].position) == ("RUNNING", "NONE", "3")
    assert rows[0].event_timestamp.microsecond == 123456


def test_reasons_of_mixed_kinds(spark, messages):
    rows = validate_messages(messages).orderBy("offset").collect()
    assert [r.reject_reason for r in rows] == [reason for _, reason in CASES]
    # A field of another kind's message is ignored.
    assert rows[-1].vibration is None


def test_source_text_and_parse_error_are_kept(spark, messages):
    rows = parse_payload(messages, ELEVATOR).orderBy("offset").collect()
    assert [r.source_json for r in rows] == [payload for payload, _ in CASES]
    unreadable = {r.source_json for r in rows if r.parse_error}
    assert {"not json", "[]", "null", message()[:40]} <= unreadable
    assert message() not in unreadable


def test_binary_payload(spark, messages):
    binary = messages.withColumn("value", F.col("value").cast("binary"))
    assert parse_payload(binary, "elevator_data").filter("speed = 1").count() > 10


def test_state_domain_is_opt_in(spark):
    source = elevator_messages(spark, [message(), message(state="broken"), message(state=None)])
    parsed = parse_payload(source, ELEVATOR)
    default = with_reject_reason(parsed, ELEVATOR).filter("reject_reason IS NOT NULL")
    assert default.count() == 0
    strict = with_reject_reason(parsed, ELEVATOR, state_domain=cat.STATE_DOMAIN)
    reasons = [r.reject_reason for r in strict.orderBy("offset").collect()]
    assert reasons == [None, cat.INVALID_STATE, cat.INVALID_STATE]


def test_lenient_and_strict_timestamps(spark):
    parsed = parse_payload(elevator_messages(spark, [message(timestamp="2026")]), ELEVATOR)
    assert with_reject_reason(parsed, ELEVATOR).first().reject_reason is None
    strict = with_reject_reason(parsed, ELEVATOR, timestamp_format="yyyy-MM-dd HH:mm:ss")
    assert strict.first().reject_reason == "timestamp_invalide"


def test_clean_columns_and_dead_letter(spark, messages):
    checked = with_reject_reason(parse_payload(messages, ELEVATOR), ELEVATOR)
    valid, rejected = split_valid(checked)
    assert to_clean_columns(valid, ELEVATOR).columns == ELEVATOR.clean_columns
    assert "load_value" in ELEVATOR.clean_columns and "load" not in ELEVATOR.clean_columns
    letters = to_rejected(rejected, ELEVATOR)
    cut = letters.filter("source_json = 'not json'").first()
    assert (cut.topic, cut.raw_payload, cut.reject_reason) == (
        "elevator_data",
        "{}",
        "identifiant_manquant",
    )
    row = letters.filter(F.col("reject_reason") == "valeur_hors_limites:engine_hours").first()
    assert row.raw_payload == (
        '{"equipment_id":"E1","type":"ELEVATOR","state":"RUNNING","temperature":20.0,'
        '"energy":10.0,"engine_hours":100001.0,"alarm":"NONE","position":"3","speed":1.0,'
        '"load_value":500.0,"direction":"UP","event_timestamp":"2026-01-01T00:00:00.123Z"}'
    )
    mixed = to_rejected_mixed(split_valid(validate_messages(messages))[1])
    assert mixed.select("topic", "raw_payload").exceptAll(letters.select("topic", "raw_payload")).isEmpty()
    assert valid.count() + letters.count() == len(CASES)


def test_unreadable_time_keeps_its_text(spark):
    source = elevator_messages(spark, [message(timestamp="bad")])
    letter = to_rejected(with_reject_reason(parse_payload(source, ELEVATOR), ELEVATOR), ELEVATOR)
    assert "bad" in letter.first().source_json and "bad" not in letter.first().raw_payload


def test_violations_long_form(spark, messages):
    checked = with_reject_reason(parse_payload(messages, ELEVATOR), ELEVATOR)
    long = violations(checked.filter(F.col("offset") == 8), ELEVATOR)
    assert {(r.rule, r.field) for r in long.collect()} == {
        ("mesure_critique_manquante", "speed"),
        ("mesure_critique_manquante", "energy"),
        ("valeur_hors_limites", "load"),
    }


def test_union_fills_missing_columns(spark):
    ids = spark.range(2).select("id")
    whole = union_rejects(ids, ids.filter("id = 0").withColumn("x", F.lit(1)))
    assert [tuple(r) for r in whole.orderBy("id", "x").collect()] == [(0, None), (0, 1), (1, None)]


def test_catalogue_is_consistent():
    for kind in KINDS:
        limited = [name for name, _, _ in kind.limits]
        assert kind.critical == [n for n in limited if n != "engine_hours"]
        assert set(limited) <= set(kind.fields) and kind.watched in kind.critical
        order = merged_schema().names
        assert [n for n in order if n in kind.fields] == kind.fields
    assert find_kind("rmg") is find_kind("rmg_data")
    assert find_kind("boat") is None


def test_all_rejects_and_valid_rows_add_up(spark, messages):
    valid, rejected = split_valid(validate_messages(messages))
    assert valid.count() + rejected.count() == messages.count()

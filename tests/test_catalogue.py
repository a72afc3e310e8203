"""The catalogue's limits, pinned: the SQL twins read the same object and would not notice."""

from helpers import message

from quayside.catalogue import KINDS, STUCK_THRESHOLD

# Lowest and highest valid measure of each kind, in the order they are reported.
LIMITS = {
    "elevator": "speed 0 5, load 0 2000, temperature -20 80, energy 0 100, engine_hours 0 100000",
    "rmg": "rail_position 0 1000, trolley_position 0 100, hoist_height 0 50, travelling_speed 0 10, "
    "load_weight 0 65000, motor_current 0 500, vibration 0 20, temperature -20 80, energy 0 100, "
    "engine_hours 0 100000",
    "rtg": "trolley_position 0 100, hoist_height 0 50, gantry_speed 0 10, load_weight 0 65000, "
    "hydraulic_pressure 0 500, vibration 0 20, temperature -20 80, energy 0 100, engine_hours 0 100000",
    "sts": "motor_temperature -20 100, vibration 0 20, container_load_kg 0 65000, "
    "trolley_position_m 0 100, spreader_height_m 0 60, movement_speed_m_s 0 10, "
    "energy_consumption_kw 0 1000, hydraulic_oil_level 0 100",
    "straddle": "position_x 0 1000, position_y 0 500, speed 0 40, container_load 0 65000, "
    "height 0 20, temperature -20 80, energy 0 100, engine_hours 0 100000",
    "tractor": "position_x 0 1000, position_y 0 500, speed 0 50, fuel_level 0 100, "
    "temperature -20 80, energy 0 100, engine_hours 0 100000",
}
WATCHED = {
    "elevator": "speed",
    "rmg": "travelling_speed",
    "rtg": "gantry_speed",
    "sts": "movement_speed_m_s",
    "straddle": "speed",
    "tractor": "speed",
}


def test_limits_and_watched_fields():
    found = {k.name: ", ".join(f"{f} {low} {high}" for f, low, high in k.limits) for k in KINDS}
    assert found == LIMITS
    assert {k.name: k.watched for k in KINDS} == WATCHED
    assert [k.topic for k in KINDS] == [f"{name}_data" for name in LIMITS]
    assert STUCK_THRESHOLD == 5


def test_fields_that_the_catalogue_does_not_know(spark):
    from quayside.operators.counts import unknown_fields

    values = [
        message(firmware="1"), message(firmware=None, extra=[1, 2]), message(), message(Speed=1), "[1]", "{", None, "5", '"x"', "{}",
    ]
    rows = [("elevator_data", v) for v in values] + [("other", message(firmware="1"))]
    found = unknown_fields(spark.createDataFrame(rows, "topic string, value string")).collect()
    assert sorted((r.topic, r.field, r.type, r.message_count) for r in found) == [
        ("elevator_data", "Speed", "BIGINT", 1), ("elevator_data", "extra", "ARRAY<BIGINT>", 1),
        ("elevator_data", "firmware", "STRING", 1), ("elevator_data", "firmware", "VOID", 1),
    ]

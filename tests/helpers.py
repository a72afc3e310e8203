"""Builders of small inputs."""

import json

BASE = {
    "equipment_id": "E1",
    "type": "ELEVATOR",
    "timestamp": "2026-01-01T00:00:00.123456",
    "state": " running ",
    "position": 3,
    "speed": 1,
    "load": 500,
    "direction": "up",
    "temperature": 20,
    "energy": 10,
    "engine_hours": None,
    "alarm": "none",
}


def message(**changes):
    return json.dumps({**BASE, **changes})


def elevator_messages(spark, payloads, topic="elevator_data", start=0):
    """``topic, key, value, offset`` rows in arrival order."""
    rows = [(topic, "E", p, start + i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "topic string, key string, value string, offset bigint")


def reading(second, speed, **changes):
    return message(timestamp=f"2026-01-01T00:{second // 60:02d}:{second % 60:02d}", speed=speed, **changes)

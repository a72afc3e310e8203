"""The declarative catalogue: one frozen record per equipment kind.

Every operator that needs to know a schema, a limit or a measure list asks a
``Kind``; none of them repeats that knowledge.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: reject reasons, written to the dead letter as data ---------
MISSING_ID = "identifiant_manquant"
MISSING_TIMESTAMP = "timestamp_manquant"
INVALID_TIMESTAMP = "timestamp_invalide"
MISSING_MEASURE = "mesure_critique_manquante:"
OUT_OF_RANGE = "valeur_hors_limites:"
STUCK_SENSOR = "capteur_bloque"
# Opt-in rule, not part of the default reasons.
INVALID_STATE = "etat_invalide"
STATE_DOMAIN = ("RUNNING", "IDLE", "WAITING", "MAINTENANCE")

# --- fixed values: stuck-sensor defaults and the stream's rate limit ----------
STUCK_THRESHOLD = 5
STUCK_TOLERANCE = 1e-9
MAX_OFFSETS_PER_TRIGGER = 10_000


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
}


def struct_of(columns: str) -> T.StructType:
    """``"name TYPE, ..."`` as a struct, without the session that DDL needs."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Incident:
    """What the hourly fact counts beside the rows: ``column <op> value``."""

    column: str
    count_name: str
    value: str
    negated: bool = False

    def predicate(self) -> Column:
        # A NULL column makes the predicate NULL, and NULL is not counted.
        test = F.col(self.column) == self.value
        return ~test if self.negated else test


ALARM = Incident("alarm", "alarm_count", "NONE", negated=True)
FAULT = Incident("status", "fault_count", "FAULT")


@dataclass(frozen=True)
class Kind:
    name: str
    topic: str
    label: str
    type_tag: str
    message: str
    """Columns of the JSON payload, in message order."""
    limits: tuple[tuple[str, float, float], ...]
    """(field, low, high), inclusive; the order is the order of names in a reason."""
    text_fields: tuple[str, ...]
    watched: str
    """Field monitored for stuck values."""
    incident: Incident = ALARM
    counter: str | None = "engine_hours"
    """Cumulative counter: may be missing, and the fact keeps only its maximum."""
    renames: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def schema(self) -> T.StructType:
        return struct_of(self.message)

    @property
    def fields(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def critical(self) -> list[str]:
        return [name for name, _, _ in self.limits if name != self.counter]

    def clean_name(self, name: str) -> str:
        return self.renames.get(name, name)

    @property
    def measures(self) -> list[str]:
        return [self.clean_name(name) for name in self.critical]

    @property
    def numeric_fields(self) -> list[str]:
        return [self.clean_name(name) for name, _, _ in self.limits]

    @property
    def status_field(self) -> str:
        return self.incident.column

    @property
    def clean_columns(self) -> list[str]:
        """Columns of the clean table: ``timestamp`` becomes ``event_timestamp``."""
        return [
            "event_timestamp" if name == "timestamp" else self.clean_name(name)
            for name in self.fields
        ]

    @property
    def payload_columns(self) -> list[str]:
        """Columns of the dead-letter payload: event time comes last."""
        kept = [c for c in self.clean_columns if c != "event_timestamp"]
        return [*kept, "event_timestamp"]


# --- fixed values: message schemas, limits and text fields per kind -----------
_COMMON = (
    "equipment_id STRING, type STRING, timestamp STRING, state STRING, "
    "temperature DOUBLE, energy DOUBLE, engine_hours DOUBLE, alarm STRING"
)
_COMMON_LIMITS = (
    ("temperature", -20, 80),
    ("energy", 0, 100),
    ("engine_hours", 0, 100000),
)

ELEVATOR = Kind(
    name="elevator",
    topic="elevator_data",
    label="Elevator",
    type_tag="ELEVATOR",
    message=f"{_COMMON}, position STRING, speed DOUBLE, load DOUBLE, direction STRING",
    limits=(("speed", 0, 5), ("load", 0, 2000), *_COMMON_LIMITS),
    text_fields=("state", "alarm", "direction"),
    watched="speed",
    renames={"load": "load_value"},
)

RMG = Kind(
    name="rmg",
    topic="rmg_data",
    label="Rail Mounted Gantry (RMG)",
    type_tag="RMG",
    message=(
        f"{_COMMON}, rail_position DOUBLE, trolley_position DOUBLE, hoist_height DOUBLE, "
        "travelling_speed DOUBLE, load_weight DOUBLE, motor_current DOUBLE, vibration DOUBLE"
    ),
    limits=(
        ("rail_position", 0, 1000),
        ("trolley_position", 0, 100),
        ("hoist_height", 0, 50),
        ("travelling_speed", 0, 10),
        ("load_weight", 0, 65000),
        ("motor_current", 0, 500),
        ("vibration", 0, 20),
        *_COMMON_LIMITS,
    ),
    text_fields=("state", "alarm"),
    watched="travelling_speed",
)

RTG = Kind(
    name="rtg",
    topic="rtg_data",
    label="Rubber Tyred Gantry (RTG)",
    type_tag="RTG",
    message=(
        f"{_COMMON}, trolley_position DOUBLE, hoist_height DOUBLE, gantry_speed DOUBLE, "
        "load_weight DOUBLE, hydraulic_pressure DOUBLE, vibration DOUBLE"
    ),
    limits=(
        ("trolley_position", 0, 100),
        ("hoist_height", 0, 50),
        ("gantry_speed", 0, 10),
        ("load_weight", 0, 65000),
        ("hydraulic_pressure", 0, 500),
        ("vibration", 0, 20),
        *_COMMON_LIMITS,
    ),
    text_fields=("state", "alarm"),
    watched="gantry_speed",
)

STS = Kind(
    name="sts",
    topic="sts_data",
    label="Ship-to-Shore Crane (STS)",
    type_tag="STS",
    message=(
        "equipment_id STRING, type STRING, timestamp STRING, state STRING, "
        "motor_temperature DOUBLE, vibration DOUBLE, container_load_kg DOUBLE, "
        "trolley_position_m DOUBLE, spreader_height_m DOUBLE, movement_speed_m_s DOUBLE, "
        "energy_consumption_kw DOUBLE, hydraulic_oil_level DOUBLE, status STRING"
    ),
    limits=(
        ("motor_temperature", -20, 100),
        ("vibration", 0, 20),
        ("container_load_kg", 0, 65000),
        ("trolley_position_m", 0, 100),
        ("spreader_height_m", 0, 60),
        ("movement_speed_m_s", 0, 10),
        ("energy_consumption_kw", 0, 1000),
        ("hydraulic_oil_level", 0, 100),
    ),
    text_fields=("state", "status"),
    watched="movement_speed_m_s",
    incident=FAULT,
    counter=None,
)

STRADDLE = Kind(
    name="straddle",
    topic="straddle_data",
    label="Straddle Carrier",
    type_tag="STRADDLE",
    message=(
        f"{_COMMON}, position_x DOUBLE, position_y DOUBLE, speed DOUBLE, "
        "container_load DOUBLE, height DOUBLE, operation_mode STRING"
    ),
    limits=(
        ("position_x", 0, 1000),
        ("position_y", 0, 500),
        ("speed", 0, 40),
        ("container_load", 0, 65000),
        ("height", 0, 20),
        *_COMMON_LIMITS,
    ),
    text_fields=("state", "alarm", "operation_mode"),
    watched="speed",
)

TRACTOR = Kind(
    name="tractor",
    topic="tractor_data",
    label="Terminal Tractor",
    type_tag="TRACTOR",
    message=(
        f"{_COMMON}, position_x DOUBLE, position_y DOUBLE, speed DOUBLE, "
        "fuel_level DOUBLE, container_attached BOOLEAN, operation_mode STRING"
    ),
    limits=(
        ("position_x", 0, 1000),
        ("position_y", 0, 500),
        ("speed", 0, 50),
        ("fuel_level", 0, 100),
        *_COMMON_LIMITS,
    ),
    text_fields=("state", "alarm", "operation_mode"),
    watched="speed",
)
# --- end of fixed values ------------------------------------------------------

# The order is also the priority with which an id shared by two kinds gets its type.
KINDS: tuple[Kind, ...] = (ELEVATOR, RMG, RTG, STS, STRADDLE, TRACTOR)


def find_kind(name: str, kinds: tuple[Kind, ...] = KINDS) -> Kind | None:
    """Look a kind up by name or topic; ``None`` when unknown."""
    return next((k for k in kinds if name in (k.name, k.topic)), None)


def resolve(kind: str | Kind) -> Kind:
    if isinstance(kind, Kind):
        return kind
    found = find_kind(kind)
    if found is None:
        raise ValueError(f"unknown equipment kind: {kind!r}")
    return found


def merged_schema(kinds: tuple[Kind, ...] = KINDS) -> T.StructType:
    """One struct holding every field of every kind.

    The order keeps each kind's own message order, so JSON written from the
    wide row lists a kind's fields as its own message does.
    """
    order: TopologicalSorter[str] = TopologicalSorter()
    types: dict[str, T.DataType] = {}
    for kind in kinds:
        before: tuple[str, ...] = ()
        for f in kind.schema.fields:
            if types.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"field {f.name} has two types across kinds")
            order.add(f.name, *before)
            before = (f.name,)
    return T.StructType([T.StructField(n, types[n]) for n in order.static_order()])


def owners(field_name: str, kinds: tuple[Kind, ...] = KINDS) -> list[Kind]:
    return [k for k in kinds if field_name in k.fields]

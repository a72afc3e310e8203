"""What each registered query must return, in SQL over the same tables."""

from __future__ import annotations

from quayside.bindings.frames import (
    AS_OF,
    EVENT_TYPES,
    READING,
    SHIPMENT,
)
from quayside.bindings.queries import CUT, HISTORY_DAYS, LATER, MANY
from quayside.catalogue import KINDS, Kind

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def reason_case(kind: Kind, event_time: str = "event_timestamp") -> str:
    missing = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in kind.critical)
    outside = ", ".join(
        f"CASE WHEN {f} < {low} OR {f} > {high} THEN '{f}' END" for f, low, high in kind.limits
    )
    return f"""CASE
      WHEN equipment_id IS NULL OR trim(equipment_id) = '' THEN 'identifiant_manquant'
      WHEN timestamp IS NULL OR trim(timestamp) = '' THEN 'timestamp_manquant'
      WHEN {event_time} IS NULL THEN 'timestamp_invalide'
      WHEN concat_ws(',', {missing}) <> ''
        THEN 'mesure_critique_manquante:' || concat_ws(',', {missing})
      WHEN concat_ws(',', {outside}) <> ''
        THEN 'valeur_hors_limites:' || concat_ws(',', {outside}) END"""


def date_hour(ts: str) -> str:
    return (
        f"CAST(extract(year FROM {ts}) * 10000 + extract(month FROM {ts}) * 100"
        f" + extract(day FROM {ts}) AS INTEGER) AS date_key,"
        f" CAST(extract(hour FROM {ts}) AS INTEGER) AS hour_key"
    )


def aggregates(kind: Kind) -> str:
    incident = kind.incident
    op = "<>" if incident.negated else "="
    columns = [
        "count(*) AS measurement_count",
        f"count(*) FILTER (WHERE {incident.column} {op} '{incident.value}')"
        f" AS {incident.count_name}",
    ]
    for m in kind.measures:
        columns += [f"round({f}({m}), 6) AS {f}_{m}" for f in ("avg", "min", "max")]
    if kind.counter:
        columns.append(f"round(max({kind.counter}), 6) AS max_{kind.counter}")
    return ", ".join(columns)


def numbered(ids: str) -> str:
    """Surrogate keys count off ids by hash bucket, then by id."""
    return (
        "SELECT *, CAST(row_number() OVER (ORDER BY substr(md5(equipment_id), 1, 3), equipment_id)"
        f" AS BIGINT) AS equipment_key FROM ({ids})"
    )


# --- readings -------------------------------------------------------------------------

READINGS = f"""readings AS (
  SELECT event_id AS seq, event_type AS topic,
    CASE WHEN event_id % 89 = 0 THEN '  ' ELSE CAST(user_id AS VARCHAR) END AS equipment_id,
    'READING' AS type,
    CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 = 0 THEN 'bad'
      ELSE strftime(ts, {ISO}) END AS timestamp,
    CASE WHEN event_id % 97 <> 0 AND event_id % 101 <> 0 THEN ts END AS event_timestamp,
    upper(trim(event_type)) AS state,
    CASE WHEN event_id % 53 <> 0 THEN value END AS value,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
    event_id / 10.0::DOUBLE AS engine_hours,
    CASE WHEN event_type = 'error' THEN 'OVERHEAT' WHEN event_id % 7 <> 0 THEN 'NONE' END AS alarm,
    ts AS arrived_at
  FROM events)"""
CHECKED = f"checked AS (SELECT *, {reason_case(READING)} AS reject_reason FROM readings)"
VALID = "valid AS (SELECT * FROM checked WHERE reject_reason IS NULL)"
LETTERS = """letters AS (
  SELECT *, arrived_at + INTERVAL 90 SECOND AS rejected_at
  FROM checked WHERE reject_reason IS NOT NULL)"""
READING_DIM = "dim AS (" + numbered("SELECT DISTINCT equipment_id FROM valid") + ")"
FACT = f"""fact AS (
  SELECT equipment_key, date_key, hour_key, {aggregates(READING)}
  FROM (SELECT *, {date_hour('event_timestamp')} FROM valid) JOIN dim USING (equipment_id)
  GROUP BY ALL)"""
REJECTED_FACT = f"""rejected_fact AS (
  SELECT date_key, hour_key, topic, reject_reason, count(*) AS rejected_count
  FROM (SELECT *, {date_hour('rejected_at')} FROM letters) GROUP BY ALL)"""
VALID_CTES = ctes(READINGS, CHECKED, VALID)
FACT_CTES = ctes(READINGS, CHECKED, VALID, READING_DIM, FACT)
REJECTED_CTES = ctes(READINGS, CHECKED, LETTERS, REJECTED_FACT)
READING_COLUMNS = (
    "equipment_id, type, event_timestamp, state, value, k, round(engine_hours, 6) AS engine_hours,"
    " alarm, seq, topic"
)
AS_OF_SQL = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
TARGET_HOUR = f"date_trunc('hour', {AS_OF_SQL}) - INTERVAL 1 HOUR"


def json_text(fields: dict[str, str]) -> str:
    """JSON object of SQL text expressions; NULL ones are left out."""
    pairs = [f"""CASE WHEN {value} IS NOT NULL THEN '"{name}":' || {value} END"""
             for name, value in fields.items()]
    return "'{' || concat_ws(',', " + ", ".join(pairs) + ") || '}'"


def quoted(expr: str) -> str:
    return f"""('"' || {expr} || '"')"""


PAYLOAD = json_text(
    {
        "equipment_id": quoted("equipment_id"),
        "type": quoted("type"),
        "state": quoted("state"),
        "value": "CAST(value AS VARCHAR)",
        "k": "CAST(k AS VARCHAR)",
        "engine_hours": "CAST(engine_hours AS VARCHAR)",
        "alarm": quoted("alarm"),
        "event_timestamp": quoted("(strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')"),
    }
)

# --- levels and runs ------------------------------------------------------------------

LEVELS = """levels AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS equipment_id, ts AS event_timestamp,
    CAST(floor(value / 25) AS DOUBLE) AS level
  FROM events)"""


def runs(source: str, key: str, order: str, value: str, name: str = "runs") -> str:
    return f"""{name}_step AS (
  SELECT *, CASE WHEN abs({value} - lag({value}) OVER (PARTITION BY {key} ORDER BY {order})) < 1e-9
    THEN 0 ELSE 1 END AS changed FROM {source}),
{name}_island AS (
  SELECT *, sum(changed) OVER (PARTITION BY {key} ORDER BY {order}
    ROWS UNBOUNDED PRECEDING) AS island FROM {name}_step),
{name} AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {key}, island ORDER BY {order}) AS BIGINT)
    AS run_length FROM {name}_island)"""


RUNS = ctes(LEVELS, runs("levels", "equipment_id", "event_timestamp, seq", "level"))
IS_STUCK = "(run_length >= 5 AND abs(level) > 1e-9)"
RUN_ROWS = f"{RUNS}SELECT seq, level, run_length, {IS_STUCK} AS is_stuck FROM runs"

GAPS = ctes(
    LEVELS,
    """gaps AS (
  SELECT seq, CASE WHEN seq % 83 <> 0 THEN equipment_id END AS equipment_id, event_timestamp,
    CASE WHEN seq % 41 <> 0 THEN level END AS level FROM levels)""",
    "live AS (SELECT * FROM gaps WHERE equipment_id IS NOT NULL AND level IS NOT NULL)",
    runs("live", "equipment_id", "event_timestamp, seq", "level"),
)
GAP_ROWS = f"""{GAPS}SELECT seq, level, run_length, {IS_STUCK} AS is_stuck FROM runs
UNION ALL SELECT seq, level, CAST(NULL AS BIGINT), false FROM gaps
  WHERE equipment_id IS NULL OR level IS NULL"""

# --- telemetry ------------------------------------------------------------------------

EV = """ev AS (
  SELECT e.event_id, e.user_id, e.event_type, e.value, e.ts, c.copy,
    CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k
  FROM events e JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR e.event_id % 50 = 0)"""


def field_sql(kind: Kind, name: str) -> str:
    for i, (limited, low, high) in enumerate(kind.limits):
        if limited != name:
            continue
        if name == kind.watched:
            share = "least(floor(value / 25), 11) / 10.0::DOUBLE"
        else:
            share = f"((event_id * {7 + 2 * i} + k * {3 + i}) % 103) / 100.0::DOUBLE"
        every = 5 if name == kind.counter else 61
        # Multiplied before divided, as the messages are.
        product = share.replace(" / 1", f" * {high - low}::DOUBLE / 1", 1)
        return (
            f"CASE WHEN (event_id + {13 * i}) % {every} <> 0"
            f" THEN {low}::DOUBLE + {product} END"
        )
    return {
        "equipment_id": f"CASE WHEN event_id % 89 <> 0 THEN '{kind.type_tag}-' || user_id END",
        "type": f"'{kind.type_tag}'",
        "timestamp": (
            "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'bad'"
            f" ELSE strftime(ts, {ISO}) END"
        ),
        "state": (
            "CASE event_type WHEN 'click' THEN ' running ' WHEN 'view' THEN 'Idle'"
            " WHEN 'error' THEN 'maintenance' WHEN 'purchase' THEN 'WAITING ' ELSE 'parked' END"
        ),
        "alarm": (
            "CASE WHEN event_type = 'error' THEN ' overheat'"
            " WHEN event_id % 7 <> 0 THEN 'none' END"
        ),
        "status": "CASE WHEN event_type = 'error' THEN 'fault' ELSE 'ok' END",
        "direction": "CASE WHEN k % 2 = 0 THEN 'up' ELSE 'down ' END",
        "operation_mode": "CASE WHEN k % 2 = 0 THEN 'auto' ELSE ' manual' END",
        "position": "CAST(k AS VARCHAR)",
        "container_attached": "(k % 2 = 0)",
    }[name]


def message_cte(kind: Kind) -> str:
    fields = ", ".join(
        f"CASE WHEN event_id % 211 <> 0 THEN {field_sql(kind, f)} END AS {f}" for f in kind.fields
    )
    return f"""msg_{kind.name} AS (
  SELECT event_id * 2 + copy AS "offset", event_id % 211 = 0 AS parse_error, {fields},
    CASE WHEN event_id % 211 <> 0 AND event_id % 97 <> 0 AND event_id % 101 <> 0 THEN ts END
      AS event_timestamp
  FROM ev WHERE user_id % {len(KINDS)} = {KINDS.index(kind)})"""


def checked_cte(kind: Kind) -> str:
    normal = ", ".join(f"upper(trim({f})) AS {f}" for f in kind.text_fields)
    return f"""chk_{kind.name} AS (
  SELECT * REPLACE ({normal}), {reason_case(kind)} AS reject_reason FROM msg_{kind.name})"""


def clean_cte(kind: Kind) -> str:
    renamed = ", ".join(f"{old} AS {new}" for old, new in kind.renames.items())
    star = f"* RENAME ({renamed})" if renamed else "*"
    return f"""clean_{kind.name} AS (
  SELECT {star} FROM chk_{kind.name} WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY equipment_id, event_timestamp ORDER BY "offset") = 1)"""


def kind_ctes(kind: Kind, *more: str) -> str:
    return ctes(EV, message_cte(kind), checked_cte(kind), clean_cte(kind), *more)


def all_kinds() -> str:
    """CTEs up to ``outcome``: every message kept, with its verdict."""
    valid = "\nUNION ALL ".join(
        f"SELECT '{k.topic}' AS topic, \"offset\", equipment_id, event_timestamp,"
        f" {k.clean_name(k.watched)} AS watched FROM clean_{k.name}"
        for k in KINDS
    )
    bad = "\nUNION ALL ".join(
        f"SELECT '{k.topic}' AS topic, equipment_id, event_timestamp, reject_reason,"
        f" NULL::DOUBLE AS watched, NULL::BIGINT AS run_length"
        f" FROM chk_{k.name} WHERE reject_reason IS NOT NULL"
        for k in KINDS
    )
    return ctes(
        EV,
        *[c for k in KINDS for c in (message_cte(k), checked_cte(k), clean_cte(k))],
        f"survivors AS ({valid})",
        runs("survivors", "topic, equipment_id", 'event_timestamp, "offset"', "watched"),
        f"""outcome AS (
  SELECT topic, equipment_id, event_timestamp,
    CASE WHEN run_length >= 5 AND abs(watched) > 1e-9 THEN 'capteur_bloque' END AS reject_reason,
    watched, run_length FROM runs
  UNION ALL {bad})""",
    )


OUTCOME = all_kinds()
VERDICTS = f"{OUTCOME}SELECT topic, equipment_id, event_timestamp, reject_reason FROM outcome"


def rounded(kind: Kind, names: list[str]) -> str:
    numeric = set(kind.numeric_fields) | {n for n, _, _ in kind.limits}
    return ", ".join(f"round({n}, 6) AS {n}" if n in numeric else n for n in names)


# --- raw ------------------------------------------------------------------------------

RAW = """raw_rows AS (
  SELECT 'elevator' AS equipment_type, CAST(user_id AS VARCHAR) AS equipment_id,
    date_trunc('day', ts) + CASE WHEN extract(hour FROM ts) >= 12 THEN INTERVAL 12 HOUR
      ELSE INTERVAL 0 HOUR END AS timestamp,
    event_id AS seq,
    CASE WHEN event_id % 3 <> 0 THEN event_type END AS state,
    CASE WHEN event_id % 4 <> 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS speed,
    strftime(ts, '%Y-%m-%d') AS day_bucket
  FROM events)"""
SHEET = """sheet AS (
  SELECT CAST(event_id AS VARCHAR) AS seq, CAST(user_id AS VARCHAR) AS equipment_id,
    upper(event_type) AS type,
    CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id % 17 = 0 THEN 'soon'
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END END AS timestamp,
    CAST(user_id % 9 AS VARCHAR) AS speed, ts, event_id
  FROM events WHERE event_id % 10 <> 0)"""


def last_write(keys: str) -> str:
    return (
        f"SELECT {keys}, arg_max(state, seq) FILTER (WHERE state IS NOT NULL) AS state,"
        " arg_max(speed, seq) FILTER (WHERE speed IS NOT NULL) AS speed, max(seq) AS seq"
        f" FROM raw_rows GROUP BY {keys}"
    )


# --- fleet ----------------------------------------------------------------------------


def fleet(kind: Kind, source: str, weighted: bool = False) -> str:
    columns = []
    for m in kind.measures:
        mean = f"sum(avg_{m} * measurement_count) / sum(measurement_count)" if weighted else (
            f"avg(avg_{m})")
        columns += [f"round({mean}, 6) AS avg_{m}", f"min(min_{m}) AS min_{m}",
                    f"max(max_{m}) AS max_{m}"]
    if kind.counter:
        columns.append(f"max(max_{kind.counter}) AS max_{kind.counter}")
    name = kind.incident.count_name
    columns += [
        "CAST(sum(measurement_count) AS BIGINT) AS measurement_count",
        f"CAST(sum({name}) AS BIGINT) AS {name}",
    ]
    return f"SELECT date_key, hour_key, {', '.join(columns)} FROM {source} GROUP BY 1, 2"


def unrounded(sql: str) -> str:
    """Facts that feed a further average keep their precision."""
    return sql.replace("round(avg(", "(avg(").replace("), 6) AS avg_", ")) AS avg_")


SHIPMENT_FACT = f"""shipment_fact AS (
  SELECT l_suppkey + 1 AS equipment_key, l_suppkey, {{keys}}, {aggregates(SHIPMENT)}
  FROM (SELECT *, l_quantity AS quantity, l_extendedprice AS price, l_shipdate AS t,
    CASE WHEN l_returnflag = 'R' THEN 'RETURNED' ELSE 'NONE' END AS alarm FROM lineitem)
  JOIN supplier ON s_suppkey = l_suppkey
  GROUP BY l_suppkey, date_key, hour_key)""".replace("{keys}", date_hour("t"))

DIM_DATE = """SELECT DISTINCT
  CAST(extract(year FROM d) * 10000 + extract(month FROM d) * 100 + extract(day FROM d) AS INTEGER)
    AS date_key,
  d AS full_date, CAST(extract(year FROM d) AS INTEGER) AS year,
  CAST(extract(month FROM d) AS INTEGER) AS month, CAST(extract(day FROM d) AS INTEGER) AS day,
  CAST(extract(isodow FROM d) AS INTEGER) AS day_of_week,
  CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
  monthname(d) AS month_name, extract(isodow FROM d) IN (6, 7) AS is_weekend
FROM (SELECT CAST({ts} AS DATE) AS d FROM {table})"""

IMPORTED = f"""{ctes(SHEET)}SELECT seq, equipment_id, type, speed,
  CASE WHEN timestamp IS NULL THEN {AS_OF_SQL} WHEN timestamp <> 'soon'
    THEN date_trunc('second', ts) END AS timestamp,
  CASE WHEN timestamp IS NULL THEN '{AS_OF:%Y-%m-%d}' WHEN timestamp <> 'soon'
    THEN strftime(ts, '%Y-%m-%d') END AS day_bucket,
  CASE WHEN timestamp = 'soon' THEN 'timestamp_invalide' END AS reject_reason
FROM sheet"""
DATED = f"""CASE WHEN timestamp IS NULL THEN {AS_OF_SQL} ELSE date_trunc('second', ts) END"""
KEPT = f"""kept AS (SELECT DISTINCT lower(type) AS type, equipment_id, {DATED} AS timestamp
  FROM sheet WHERE type <> 'VIEW' AND timestamp IS DISTINCT FROM 'soon')"""
INGESTED = f"""{ctes(SHEET, KEPT)}SELECT part, count(*) AS row_count FROM (
  SELECT type AS part FROM kept
  UNION ALL SELECT CASE WHEN type = 'VIEW' THEN 'type_inconnu' ELSE 'timestamp_invalide' END
    FROM sheet WHERE type = 'VIEW' OR timestamp = 'soon') GROUP BY part"""
PUBLISHED = f"""{ctes(SHEET, KEPT)}SELECT type AS topic, equipment_id AS key,
  strftime(timestamp, {ISO}) AS timestamp FROM kept"""

HOURS = (
    f"{VALID_CTES}SELECT equipment_id, date_key, hour_key, {aggregates(READING)}"
    f" FROM (SELECT *, {date_hour('event_timestamp')} FROM valid)"
    " GROUP BY equipment_id, date_key, hour_key"
)

ORACLES: dict[str, str] = {
    "reject_reason": f"{ctes(READINGS, CHECKED)}"
    "SELECT seq, equipment_id, event_timestamp, state, alarm, reject_reason FROM checked",
    "clean_rows": f"{VALID_CTES}SELECT {READING_COLUMNS} FROM valid",
    "rejected_rows": f"{ctes(READINGS, CHECKED, LETTERS)}"
    f"SELECT 'reading' AS topic, equipment_id, {PAYLOAD} AS raw_payload, reject_reason,"
    " event_timestamp, rejected_at FROM letters",
    "state_domain_check": f"{ctes(READINGS, CHECKED)}SELECT seq, state, coalesce(reject_reason,"
    " CASE WHEN state NOT IN ('CLICK', 'PURCHASE', 'VIEW') THEN 'etat_invalide' END)"
    " AS reject_reason FROM checked",
    "parse_timestamp": f"{ctes(READINGS)}SELECT seq, event_timestamp AS message_time,"
    " date_trunc('second', event_timestamp) AS import_time FROM readings",
    "day_bucket": f"{ctes(READINGS)}SELECT seq, coalesce(event_timestamp, {AS_OF_SQL})"
    f" AS timestamp, strftime(coalesce(event_timestamp, {AS_OF_SQL}), '%Y-%m-%d') AS day_bucket"
    " FROM readings",
    "date_hour_keys": f"SELECT event_id AS seq, {date_hour('ts')} FROM events",
    "normalize_text": "SELECT p_partkey, upper(p_name) AS p_name, upper(trim(p_brand)) AS p_brand,"
    " p_type FROM part",
    "textify": f"{ctes(LEVELS)}SELECT seq, event_timestamp AS timestamp, equipment_id,"
    " CAST(seq % 1000 AS VARCHAR) AS load, CAST(level AS VARCHAR) AS level,"
    " CASE WHEN level > 1 THEN 'True' ELSE 'False' END AS container_attached FROM levels",
    "infer_type": """SELECT event_id AS seq,
  CASE event_id % 7 WHEN 0 THEN 'bool' WHEN 1 THEN 'bool' WHEN 2 THEN 'int' WHEN 3 THEN 'float'
    WHEN 4 THEN 'text' WHEN 5 THEN 'text' END AS loose_type,
  CASE event_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN CAST(user_id AS VARCHAR)
    WHEN 3 THEN CAST(value AS VARCHAR) WHEN 4 THEN '"' || event_type || '"'
    WHEN 5 THEN '"' || user_id || 'f"' END AS loose_json
FROM events""",
    "infer_type_catalogue": f"{ctes(READINGS)}SELECT seq, equipment_id, type, timestamp,"
    " ' ' || topic || ' ' AS state, value, k, round(engine_hours, 6) AS engine_hours,"
    " lower(alarm) AS alarm FROM readings",
    "to_keyed_json": f"{ctes(LEVELS)}SELECT equipment_id AS key, "
    + json_text(
        {
            "equipment_id": quoted("equipment_id"),
            "seq": "CAST(seq AS VARCHAR)",
            "level": "CAST(level AS VARCHAR)",
            "alarm": "(CASE WHEN seq % 7 <> 0 THEN '\"NONE\"' END)",
        }
    )
    + " AS value FROM levels WHERE seq % 89 <> 0",
    "clean_messages": VERDICTS,
    "stream_clean": VERDICTS,
    "batch_loads_stuck": VERDICTS,
    "equipment_ids_indexed": f"SELECT DISTINCT equipment_id FROM ({VERDICTS}) WHERE reject_reason IS NULL",
    "compacted_clean": VERDICTS,
    "load_then_stream": VERDICTS,
    "stream_batch_counts": f"SELECT 3 AS batches, count(*) FILTER (reject_reason IS NULL) AS valid_count,"
    " count(reject_reason) AS rejected_count, count(*) FILTER (reject_reason = 'capteur_bloque') AS stuck_count"
    f" FROM ({VERDICTS})",
    "payload_drift": f"""{ctes(EV)}, more AS (
  SELECT list_extract({[k.topic for k in KINDS]}, CAST(user_id % {len(KINDS)} AS INTEGER) + 1) AS topic, event_id * 2 + copy AS "offset"
  FROM ev WHERE (event_id * 2 + copy) % 10 = 0 AND event_id % 211 <> 0
)
SELECT topic, field, type, count(*) AS message_count FROM more, LATERAL (VALUES
  ('firmware', 'STRING'), ('nested', 'OBJECT<a: DECIMAL(2,1)>'), ('retries', CASE WHEN "offset" % 20 = 0 THEN 'BIGINT' ELSE 'VOID' END)) AS found(field, type)
GROUP BY ALL""",
    "stream_after_load": VERDICTS,
    "latest_many": f"SELECT equipment_id, event_timestamp FROM ({VERDICTS})"
    f" WHERE topic = '{KINDS[0].topic}' AND reject_reason IS NULL"
    f" ORDER BY event_timestamp DESC, equipment_id DESC LIMIT {MANY}",
    "stuck_rows": f"{OUTCOME}SELECT topic, equipment_id, event_timestamp, round(watched, 6)"
    " AS watched, run_length FROM outcome WHERE reject_reason = 'capteur_bloque'",
    "batch_counts": f"{OUTCOME}SELECT topic,"
    " count(*) FILTER (WHERE reject_reason IS NULL) AS valid_count,"
    " count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected_count,"
    " count(*) FILTER (WHERE reject_reason = 'capteur_bloque') AS stuck_count"
    " FROM outcome GROUP BY topic",
    "reject_rate": f"{OUTCOME}SELECT count(*) AS row_count, count(reject_reason) AS rejected_count,"
    " round(count(reject_reason) / count(*), 6) AS reject_rate FROM outcome",
    "topic_profile": f"{ctes(EV)}SELECT list_extract({[k.topic for k in KINDS]},"
    f" CAST(user_id % {len(KINDS)} AS INTEGER) + 1) AS topic, count(*) AS row_count,"
    " count(DISTINCT user_id) AS equipment_count FROM ev GROUP BY 1",
    "union_rejects": ctes(
        EV,
        *[
            c
            for k in KINDS
            for c in (
                message_cte(k),
                checked_cte(k),
                clean_cte(k),
                runs(
                    f"clean_{k.name}",
                    "equipment_id",
                    'event_timestamp, "offset"',
                    k.clean_name(k.watched),
                    f"runs_{k.name}",
                ),
            )
        ],
    )
    + "\nUNION ALL ".join(
        f"SELECT '{k.name}' AS equipment_type, \"offset\", equipment_id, reject_reason,"
        f" NULL::BIGINT AS run_length FROM chk_{k.name} WHERE reject_reason IS NOT NULL"
        f"\nUNION ALL SELECT '{k.name}', \"offset\", equipment_id, 'capteur_bloque', run_length"
        f" FROM runs_{k.name} WHERE run_length >= 5 AND abs({k.clean_name(k.watched)}) > 1e-9"
        for k in KINDS
    ),
    "stuck_runs": RUN_ROWS,
    "stuck_runs_split": RUN_ROWS,
    "stuck_runs_bucketed": RUN_ROWS,
    "stuck_stream": RUN_ROWS,
    "stuck_stream_ordered": RUN_ROWS,
    "stuck_runs_gaps": GAP_ROWS,
    "stuck_stream_gaps": GAP_ROWS,
    "state_snapshot": f"{RUN_ROWS} WHERE event_timestamp >= TIMESTAMP '{CUT:%Y-%m-%d}'",
    "stuck_state": f"{RUNS}SELECT equipment_id, level AS last_value, run_length AS repeat_count"
    " FROM runs QUALIFY row_number() OVER (PARTITION BY equipment_id"
    " ORDER BY event_timestamp DESC, seq DESC) = 1",
    "dedupe_first": f"{ctes(LEVELS)}SELECT *, date_trunc('hour', event_timestamp) AS hour"
    " FROM levels QUALIFY row_number() OVER (PARTITION BY equipment_id, hour"
    " ORDER BY event_timestamp, seq) = 1",
    "split_inner": f"{RUNS}SELECT seq, equipment_id, level FROM runs"
    f" WHERE (equipment_id, event_timestamp) IN"
    f" (SELECT (equipment_id, event_timestamp) FROM runs WHERE {IS_STUCK})",
    "split_anti": f"{RUNS}SELECT seq, equipment_id, level FROM runs"
    f" WHERE (equipment_id, event_timestamp) NOT IN"
    f" (SELECT (equipment_id, event_timestamp) FROM runs WHERE {IS_STUCK})",
    "raw_upsert_table": ctes(
        RAW.replace("event_id AS seq", f"event_id + event_id % 2 * {LATER} AS seq")
    )
    + last_write("equipment_type, equipment_id, day_bucket, timestamp"),
    "scan_raw": f"{ctes(RAW)}SELECT equipment_id, timestamp, state, speed, day_bucket"
    " FROM raw_rows",
    "equipment_history": f"{ctes(RAW)}SELECT equipment_id, day_bucket, timestamp, state, speed"
    f" FROM raw_rows WHERE equipment_id = '7' AND day_bucket IN {HISTORY_DAYS}",
    "drop_blank_rows": f"{ctes(SHEET)}SELECT seq, equipment_id, type, timestamp, speed FROM sheet",
    "import_file": IMPORTED,
    "import_folder": IMPORTED,
    "raw_ingest": INGESTED,
    "raw_ingest_stream": INGESTED,
    "publish_raw": PUBLISHED,
    "route_by_type": f"{ctes(SHEET)}SELECT CASE WHEN type <> 'VIEW' THEN lower(type) END"
    " AS equipment_type, type, count(*) AS row_count FROM sheet GROUP BY ALL",
    "hour_window": f"{VALID_CTES}SELECT seq, equipment_id, event_timestamp FROM valid"
    f" WHERE event_timestamp >= {TARGET_HOUR}"
    f" AND event_timestamp < {TARGET_HOUR} + INTERVAL 1 HOUR",
    "hourly_fact": f"{FACT_CTES}SELECT * FROM fact"
    f" WHERE date_key = {AS_OF:%Y%m%d} AND hour_key = {AS_OF.hour - 1}",
    "hourly_backfill": f"{FACT_CTES}SELECT * FROM fact",
    "supplier_hourly_fact": f"{ctes(SHIPMENT_FACT)}SELECT * EXCLUDE (l_suppkey) FROM shipment_fact",
    "nation_fleet": unrounded(ctes(SHIPMENT_FACT))
    + fleet(
        SHIPMENT,
        "(SELECT * FROM shipment_fact JOIN supplier ON s_suppkey = l_suppkey"
        " WHERE s_nationkey = 3)",
    ),
    "dim_equipment": numbered(
        f"SELECT CAST(user_id AS VARCHAR) AS equipment_id, upper(list_extract({list(EVENT_TYPES)},"
        f" min(list_position({list(EVENT_TYPES)}, event_type)))) AS equipment_type"
        " FROM events GROUP BY 1"
    ),
    "dim_equipment_append": f"""WITH existing AS (
  SELECT s_suppkey + 1 AS equipment_key, CAST(s_suppkey AS VARCHAR) AS equipment_id,
    'SUPPLIER' AS equipment_type FROM supplier),
fresh AS ({numbered("SELECT DISTINCT CAST(user_id AS VARCHAR) AS equipment_id FROM events"
                    " WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)")})
SELECT * FROM existing UNION ALL
SELECT equipment_key + (SELECT max(equipment_key) FROM existing), equipment_id, 'READING'
FROM fresh""",
    "insert_if_absent": "SELECT o_orderkey, o_custkey AS user_id FROM orders"
    " WHERE o_custkey NOT IN (SELECT user_id FROM events)",
    "dim_date": DIM_DATE.format(ts="o_orderdate", table="orders"),
    "dim_date_range": """WITH days AS (
  SELECT CAST(d AS DATE) AS d FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY) t(d))
SELECT CAST(extract(year FROM d) * 10000 + extract(month FROM d) * 100 + extract(day FROM d)
    AS INTEGER) AS date_key,
  CAST(extract(isodow FROM d) AS INTEGER) AS day_of_week,
  CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
  extract(isodow FROM d) IN (6, 7) AS is_weekend, count(event_id) AS measurement_count
FROM days LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY d""",
    "dim_hour": f"""{VALID_CTES}SELECT CAST(h AS INTEGER) AS hour_key, h || 'h' AS hour_label,
  nullif(count(seq), 0) AS measurement_count,
  CASE WHEN count(seq) > 0 THEN count(*) FILTER (WHERE alarm <> 'NONE') END AS alarm_count
FROM range(24) t(h) LEFT JOIN valid ON extract(hour FROM event_timestamp) = h GROUP BY h""",
    "rejected_hourly": f"{REJECTED_CTES}SELECT * FROM rejected_fact",
    "fact_upsert": f"""{REJECTED_CTES}SELECT date_key, hour_key, topic, reject_reason,
  CASE WHEN hour_key % 2 = 1 AND topic = 'view' THEN -1 ELSE rejected_count END AS rejected_count
FROM rejected_fact""",
    "sink_clean": ctes(
        EV,
        *[c for k in KINDS for c in (message_cte(k), checked_cte(k), clean_cte(k))],
        "survivors AS ("
        + " UNION ALL ".join(
            f"SELECT '{k.name}' AS equipment_type, equipment_id, event_timestamp, \"offset\","
            f" state, {k.clean_name(k.watched)} AS watched FROM clean_{k.name}"
            for k in KINDS
        )
        + ")",
        runs("survivors", "equipment_type, equipment_id", 'event_timestamp, "offset"', "watched"),
    )
    + "SELECT equipment_type, equipment_id, event_timestamp, state FROM runs"
    " WHERE run_length < 5 OR abs(watched) <= 1e-9",
    "warehouse_load": ctes(
        EV,
        *[c for k in KINDS for c in (message_cte(k), checked_cte(k), clean_cte(k))],
        "survivors AS ("
        + " UNION ALL ".join(
            f"SELECT '{k.type_tag}' AS equipment_type, equipment_id, event_timestamp, \"offset\","
            f" {k.clean_name(k.watched)} AS watched, {k.measures[0]} AS measure,"
            f" {k.incident.column} {'<>' if k.incident.negated else '='} '{k.incident.value}'"
            f" AS incident FROM clean_{k.name}"
            for k in KINDS
        )
        + ")",
        runs("survivors", "equipment_type, equipment_id", 'event_timestamp, "offset"', "watched"),
    )
    + """SELECT equipment_type, equipment_id,
  count(DISTINCT date_trunc('hour', event_timestamp)) AS hours, count(*) AS measurement_count,
  count(*) FILTER (WHERE incident) AS incident_count, round(max(measure), 6) AS max_measure
FROM runs WHERE run_length < 5 OR abs(watched) <= 1e-9 GROUP BY 1, 2""",
    "equipment_ids": f"{VALID_CTES}SELECT DISTINCT equipment_id FROM valid ORDER BY 1",
    "latest_n": f"{VALID_CTES}SELECT {READING_COLUMNS} FROM valid"
    " ORDER BY event_timestamp DESC, equipment_id DESC LIMIT 100",
    "latest_one": f"{VALID_CTES}SELECT {READING_COLUMNS} FROM valid WHERE equipment_id = '7'"
    " ORDER BY event_timestamp DESC LIMIT 20",
    "hourly_by_equipment": f"{FACT_CTES}SELECT fact.*, equipment_id FROM fact"
    " JOIN dim USING (equipment_key) WHERE equipment_id = '7'"
    " ORDER BY date_key DESC, hour_key DESC LIMIT 48",
    "hourly_fleet": unrounded(FACT_CTES)
    + fleet(READING, "fact")
    + " ORDER BY date_key DESC, hour_key DESC LIMIT 48",
    "hourly_fleet_weighted": unrounded(FACT_CTES)
    + fleet(READING, "fact", weighted=True)
    + " ORDER BY date_key DESC, hour_key DESC LIMIT 720",
    "last_hours_filter": f"{REJECTED_CTES}SELECT * FROM rejected_fact"
    " WHERE date_key * 100 + hour_key BETWEEN 2024011413 AND 2024011519",
    "rejected_summary": f"{REJECTED_CTES}SELECT topic, reject_reason,"
    " CAST(sum(rejected_count) AS BIGINT) AS rejected_count FROM rejected_fact"
    " WHERE date_key * 100 + hour_key BETWEEN 2024011419 AND 2024011519 GROUP BY 1, 2",
    "rejected_summary_legacy": f"{REJECTED_CTES}SELECT topic, reject_reason,"
    " CAST(sum(rejected_count) AS BIGINT) AS rejected_count FROM rejected_fact"
    " WHERE date_key = 20240115 GROUP BY 1, 2",
    "rejected_total": f"{REJECTED_CTES}SELECT CAST(sum(rejected_count) AS BIGINT) AS total_rejected"
    " FROM rejected_fact WHERE date_key <= 20240115 AND date_key * 100 + hour_key <= 2024011519",
    "rejected_recent": f"{ctes(READINGS, CHECKED, LETTERS)}SELECT 'reading' AS topic, equipment_id,"
    " reject_reason, rejected_at FROM letters ORDER BY rejected_at DESC LIMIT 50",
    "stream_source": f"{ctes(EV)}SELECT list_extract({[k.topic for k in KINDS]},"
    f" CAST(user_id % {len(KINDS)} AS INTEGER) + 1) AS topic, CAST(user_id AS VARCHAR) AS key,"
    f' event_id * 2 + copy AS "offset" FROM ev WHERE user_id % {len(KINDS)} <> 3',
    "stream_dedupe": f"{ctes(LEVELS)}SELECT equipment_id, event_timestamp, level FROM levels",
    "stream_hourly": HOURS,
    "stream_hourly_open": HOURS,
    # A row is late if the batches before its own have seen a time three days after its own.
    "stream_late_rows": f"""{ctes(LEVELS)}, placed AS (
  SELECT *, CASE WHEN event_timestamp < '2024-01-11' THEN 0 WHEN event_timestamp < '2024-01-21' THEN 1 ELSE 2 END AS slice FROM levels
), arrived AS (
  SELECT *, slice + CASE WHEN seq % 31 = 0 AND slice < 2 THEN 1 ELSE 0 END AS batch FROM placed
  UNION ALL SELECT *, slice + 1 FROM placed WHERE seq % 50 = 0 AND seq % 31 <> 0 AND slice < 2
), latest AS (
  SELECT batch, date_trunc('milliseconds', max(max(event_timestamp)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    - INTERVAL 3 DAYS AS passed FROM arrived GROUP BY batch
)
SELECT seq, CASE WHEN event_timestamp < passed THEN 'en_retard'
  WHEN row_number() OVER (PARTITION BY equipment_id, event_timestamp ORDER BY batch, seq) > 1 THEN 'doublon' END AS verdict
FROM arrived JOIN latest USING (batch)""",
}

_LONG = "\nUNION ALL ".join(
    [
        f"SELECT seq, topic, 'mesure_critique_manquante' AS rule, '{f}' AS field FROM checked"
        f" WHERE {f} IS NULL"
        for f in READING.critical
    ]
    + [
        f"SELECT seq, topic, 'valeur_hors_limites', '{f}' FROM checked WHERE {f} < {lo} OR {f} > {hi}"
        for f, lo, hi in READING.limits
    ]
)
ORACLES["raw_upsert"] = ORACLES["raw_upsert_table"]
ORACLES["history_stored"] = (
    f"SELECT * FROM ({ORACLES['raw_upsert_table']}) WHERE equipment_id = '7'"
    " AND day_bucket IN ('2024-01-05', '2024-01-06', '2024-01-20')"
)
ORACLES["late_hours_load"] = ORACLES["warehouse_load"]
ORACLES["violations"] = f"{ctes(READINGS, CHECKED)}SELECT seq, rule, field FROM ({_LONG})"
ORACLES["violation_counts"] = (
    f"{ctes(READINGS, CHECKED)}SELECT topic, rule, field, count(*) AS row_count"
    f" FROM ({_LONG}) GROUP BY ALL"
)

for _kind in KINDS:
    _n = _kind.name
    ORACLES[f"parse_payload_{_n}"] = (
        f"{ctes(EV, message_cte(_kind))}"
        f'SELECT "offset", parse_error, {rounded(_kind, _kind.fields)} FROM msg_{_n}'
    )
    ORACLES[f"reject_reason_{_n}"] = (
        f'{kind_ctes(_kind)}SELECT "offset", equipment_id, event_timestamp,'
        f" {', '.join(_kind.text_fields)}, reject_reason FROM chk_{_n}"
    )
    ORACLES[f"clean_rows_{_n}"] = (
        f'{kind_ctes(_kind)}SELECT {rounded(_kind, _kind.clean_columns)}, "offset" FROM clean_{_n}'
    )
    ORACLES[f"hourly_fact_{_n}"] = (
        kind_ctes(_kind, f"dim AS ({numbered(f'SELECT DISTINCT equipment_id FROM clean_{_n}')})")
        + f"SELECT equipment_key, date_key, hour_key, {aggregates(_kind)}"
        f" FROM (SELECT *, {date_hour('event_timestamp')} FROM clean_{_n})"
        " JOIN dim USING (equipment_id) GROUP BY equipment_key, date_key, hour_key"
    )

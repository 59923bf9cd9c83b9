"""DuckDB SQL equivalents of the registered queries (the driver's correctness oracle).

Written independently of the Spark code: plain SQL over the driver's views. Helper
functions only inline repeated expressions into the SQL text.
"""

from __future__ import annotations

PERIOD_START = "2024-01-01"
PERIOD_END = "2024-01-31"
HALF_END = "2024-01-15"


def trim_ws(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def has_value(x: str) -> str:
    return f"({x} IS NOT NULL AND {trim_ws(x)} <> '' AND lower({trim_ws(x)}) <> 'null')"


def clean_text(x: str) -> str:
    return f"(CASE WHEN {has_value(x)} THEN {trim_ws(x)} END)"


def to_seconds(x: str) -> str:
    s = trim_ws(x)
    part = lambda i: f"CAST({trim_ws(f'split_part({s}, {chr(39)}:{chr(39)}, {i})')} AS BIGINT)"
    two = rf"regexp_full_match({s}, '\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*')"
    three = rf"regexp_full_match({s}, '\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*')"
    return (f"(CASE WHEN {s} LIKE '%ms' THEN NULL "
            f"WHEN {two} THEN CAST({part(1)} * 60 + {part(2)} AS DOUBLE) "
            f"WHEN {three} THEN CAST({part(1)} * 3600 + {part(2)} * 60 + {part(3)} AS DOUBLE) END)")


def normalize_caller(x: str, key: str) -> str:
    t = trim_ws(x)
    digits = f"regexp_replace({t}, '[^0-9]+', '', 'g')"
    return (f"(CASE WHEN {x} IS NULL OR {t} = '' OR lower({t}) = 'restricted' OR {digits} = '' "
            f"THEN '__restricted__:' || {key} ELSE {digits} END)")


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 OR ({b}) IS NULL THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


DIM = """(SELECT * FROM (VALUES ('8020','CSR English','English','primary',0),
  ('8021','CSR French','French','primary',1),
  ('8030','CSR Overflow English','English','overflow',2),
  ('8031','CSR Overflow French','French','overflow',3)) AS t(queue_id, queue_name, language, role, queue_pos))"""

LEGS = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(floor(value) AS BIGINT) AS v
  FROM events),
legs0 AS (
  SELECT event_id AS leg_no,
    CASE WHEN k < 70 THEN (CASE WHEN user_id % 2 = 0 THEN '8020' ELSE '8021' END)
         ELSE (CASE WHEN user_id % 2 = 0 THEN '8030' ELSE '8031' END) END AS queue_id,
    'c' || CAST(user_id * 1000 + dayofyear(ts) AS VARCHAR) AS orig_call_id,
    strftime(ts, '%m/%d/%Y %-I:%M %p') AS call_time,
    CASE WHEN user_id % 13 <> 1 THEN 'Caller ' || CAST(user_id AS VARCHAR) END AS caller_name,
    CASE WHEN user_id % 13 = 0 THEN 'Restricted' WHEN user_id % 13 = 1 THEN NULL
         ELSE '+1 (613) 555-' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') END AS caller_number,
    '6135550100' AS dnis,
    CASE WHEN k % 12 <> 0 THEN CAST(k % 12 + 100 AS VARCHAR) END AS agent_extension,
    CASE WHEN k % 12 = 4 THEN '613-555-0199' END AS agent_phone,
    '00:' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') AS time_in_queue,
    CASE WHEN k = 5 THEN '53ms' WHEN event_type IN ('error', 'signup') THEN '00:00'
         ELSE lpad(CAST(v // 60 AS VARCHAR), CAST(greatest(2, length(CAST(v // 60 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST(v % 60 AS VARCHAR), 2, '0') END AS agent_time,
    CASE WHEN k % 4 = 0 THEN '00:' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') ELSE '00:00' END AS hold_time,
    k % 12 AS slot,
    CASE WHEN event_type = 'error' THEN 'No Answer' WHEN event_type = 'signup' THEN ' Abandoned '
         WHEN event_type = 'view' THEN 'Orig: Bye' WHEN event_type = 'click' THEN 'Term: Bye'
         ELSE (CASE WHEN k % 2 = 1 THEN '' END) END AS queue_release_reason,
    CASE WHEN event_type = 'error' THEN 'No Answer' WHEN event_type = 'signup' THEN 'Abandoned'
         WHEN event_type = 'view' THEN 'Term: Bye' WHEN event_type = 'click' THEN 'Orig: Bye'
         ELSE (CASE WHEN k % 3 = 0 THEN ' null ' ELSE 'Term: 503' END) END AS agent_release_reason
  FROM ev),
legs AS (
  SELECT l.leg_no, l.queue_id, d.queue_name, d.language, d.role,
    'calls_' || l.queue_id || '_2024-01.csv' AS source_file,
    l.call_time, l.caller_name, l.caller_number, l.dnis, l.agent_extension, l.agent_phone, l.orig_call_id,
    l.time_in_queue, l.agent_time, l.hold_time,
    CASE WHEN slot = 0 THEN NULL WHEN slot = 1 THEN 'IVR System' WHEN slot = 2 THEN ' null '
         WHEN l.queue_id = '8031' AND slot <> 3 THEN 'Agent 7' ELSE 'Agent ' || CAST(slot AS VARCHAR) END AS agent_name,
    l.queue_release_reason, l.agent_release_reason
  FROM legs0 l JOIN {DIM} d USING (queue_id))"""


def curated_ctes(start: str = PERIOD_START, end: str = PERIOD_END) -> str:
    """WITH-list ending in ``curated`` (CSV path: filter -> keep-last per queue+call -> curate)."""
    return f"""WITH {LEGS},
filtered AS (
  SELECT *, strptime(call_time, '%m/%d/%Y %I:%M %p') AS call_dt FROM legs
  WHERE CAST(strptime(call_time, '%m/%d/%Y %I:%M %p') AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'),
deduped AS (
  SELECT * FROM filtered
  QUALIFY row_number() OVER (PARTITION BY queue_id, orig_call_id ORDER BY leg_no DESC) = 1),
curated AS (
  SELECT queue_id, queue_name, language, role, orig_call_id AS call_id, call_time,
    call_dt AS call_datetime, CAST(call_dt AS DATE) AS date, CAST(hour(call_dt) AS INTEGER) AS hour,
    strftime(call_dt, '%A') AS dow, caller_name, caller_number,
    {normalize_caller('caller_number', 'orig_call_id')} AS caller_number_norm,
    dnis, agent_extension, agent_phone, agent_name,
    {to_seconds('time_in_queue')} AS queue_sec,
    {to_seconds('agent_time')} AS agent_sec,
    {to_seconds('hold_time')} AS hold_sec,
    agent_release_reason, queue_release_reason,
    CASE WHEN coalesce({to_seconds('agent_time')}, 0) > 0 THEN 'Handled' ELSE 'No Agent' END AS handled_flag,
    coalesce({to_seconds('agent_time')}, 0) > 0 AS is_handled
  FROM deduped)"""


def with_curated(body: str, start: str = PERIOD_START, end: str = PERIOD_END) -> str:
    return f"{curated_ctes(start, end)}\n{body}"


def queue_paths() -> list[tuple[str, str]]:
    """(path, condition on ``ev``) of the fields in which the records of the API adapter carry their queue (J-1)."""
    from callgrid.operators.resolve import QUEUE_FIELD_CANDIDATES as paths
    known = f"k % 7 <> 0 AND event_id % {len(paths)} = "
    return [(p, f"{known}{n}") for n, p in enumerate(paths)] + [("by.user", f"{known}{len(paths) - 1}")]

"""Query family: anomalies, validation, source gaps, source statistics.

N-1…N-5, A-14, A-17, J-5, J-7, S-5, A-23, A-24, J-4.
"""

from __future__ import annotations


from callgrid import oracle as O
from callgrid.operators import anomaly as N
from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.operators import stats as S
from callgrid.operators import validate as V
from callgrid.operators.cross import consolidated_callers
from callgrid.operators.curate import curate_csv, filter_period_csv
from callgrid.operators.dedup import dedup_csv
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.plans.q_cross import CALLERS_SQL, SAME_HOUR_SQL
from callgrid.plans.q_queue import LEADERBOARD_CTE
from callgrid.schemas import DEFAULT_QUEUES, Queue, queue_dim

NON_HUMAN_SQL = "regexp_matches(lower(agent_name), 'auto attendant|builds|csh - builds|ivr|queue|system|voicemail')"
RULE_INPUTS = LEADERBOARD_CTE + f""",
hourly AS ({SAME_HOUR_SQL}),
callers AS ({CALLERS_SQL})"""

SYSTEM_SQL = """SELECT 'high' AS severity, 'system_agent' AS kind, queue_id,
  agent_name || ' appears in queue ' || queue_id || ' agent leaderboard and should be verified as human or system.' AS description,
  CAST(json_object('view', 'per-queue', 'queue_id', queue_id, 'agent_name', agent_name) AS VARCHAR) AS target_json,
  0 AS rule_order,
  CAST(rank * 2 AS BIGINT) AS item_order
FROM leaderboard WHERE agent_name IS NOT NULL AND agent_name <> '' AND """ + NON_HUMAN_SQL
SINGLE_SQL = """SELECT 'high' AS severity, 'single_agent_dependency' AS kind, queue_id,
  agent_name || ' handled more than 60% of answered calls on queue ' || queue_id || '.' AS description,
  CAST(json_object('view', 'per-queue', 'queue_id', queue_id, 'agent_name', agent_name) AS VARCHAR) AS target_json,
  0 AS rule_order,
  CAST(rank * 2 + 1 AS BIGINT) AS item_order
FROM leaderboard WHERE agent_name IS NOT NULL AND agent_name <> '' AND pct_of_answered > 0.6"""
HOURLY_RULE_SQL = """SELECT 'medium' AS severity, 'hourly_no_answer' AS kind, queue_id,
  'Queue ' || queue_id || ' has no-answer rate above 50% at ' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00.' AS description,
  CAST(json_object('view', 'per-queue', 'queue_id', queue_id, 'hour', hour) AS VARCHAR) AS target_json,
  1 AS rule_order,
  CAST(hour AS BIGINT) AS item_order
FROM hourly WHERE hour IS NOT NULL AND no_answer_rate > 0.5"""
CALLER_RULE_SQL = """SELECT 'medium' AS severity, 'caller_concentration' AS kind, CAST(NULL AS VARCHAR) AS queue_id,
  'Caller ' || caller_number_norm || ' exceeded 20 cross-queue contacts.' AS description,
  CAST(json_object('view', 'cross-queue', 'entity', caller_number_norm) AS VARCHAR) AS target_json,
  2 AS rule_order,
  CAST(0 AS BIGINT) AS item_order
FROM callers WHERE caller_number_norm IS NOT NULL AND caller_number_norm <> '' AND total_calls > 20"""


def _inputs(spark, sf_dir):
    cur = ctx.curated_shared(spark, sf_dir)
    return (M.agent_leaderboard(cur), C.hourly_volume(ctx.cube_shared(spark, sf_dir), with_avg=False),
            consolidated_callers(cur, ctx.QUEUE_IDS))


@register("anomaly_system_agent", O.with_curated(RULE_INPUTS + "\n" + SYSTEM_SQL))
def anomaly_system_agent(spark, sf_dir):
    """N-1: non-human names on a leaderboard."""
    return N.system_agent(_inputs(spark, sf_dir)[0])


@register("anomaly_single_agent", O.with_curated(RULE_INPUTS + "\n" + SINGLE_SQL))
def anomaly_single_agent(spark, sf_dir):
    """N-2: one agent above 60 % of a queue's answered calls."""
    return N.single_agent_dependency(_inputs(spark, sf_dir)[0])


@register("anomaly_hourly", O.with_curated(RULE_INPUTS + "\n" + HOURLY_RULE_SQL))
def anomaly_hourly(spark, sf_dir):
    """N-3: hours above 50 % no-answer."""
    return N.hourly_no_answer(_inputs(spark, sf_dir)[1])


@register("anomaly_caller", O.with_curated(RULE_INPUTS + "\n" + CALLER_RULE_SQL))
def anomaly_caller(spark, sf_dir):
    """N-4: callers above 20 cross-queue contacts."""
    return N.caller_concentration(_inputs(spark, sf_dir)[2])


@register("anomalies_all", O.with_curated(RULE_INPUTS + "\n" + "\nUNION ALL\n".join(
    [SYSTEM_SQL, SINGLE_SQL, HOURLY_RULE_SQL, CALLER_RULE_SQL])))
def anomalies_all(spark, sf_dir):
    """N-1…N-4 in one table (the stored ``anomalies`` rows)."""
    return N.all_anomalies(*_inputs(spark, sf_dir))


QV_SQL = O.curated_ctes() + f""",
raw AS (SELECT queue_id, count(*) AS raw_rows FROM filtered GROUP BY 1),
cur AS (SELECT queue_id, count(*) AS cleaned_calls, count(*) FILTER (WHERE is_handled) AS answered_calls
        FROM curated GROUP BY 1),
qv0 AS (SELECT d.queue_id, coalesce(raw_rows, 0) AS raw_rows, coalesce(cleaned_calls, 0) AS cleaned_calls,
        coalesce(answered_calls, 0) AS answered_calls
        FROM {O.DIM} d LEFT JOIN raw USING (queue_id) LEFT JOIN cur USING (queue_id)),
qv AS (SELECT queue_id, raw_rows, cleaned_calls, raw_rows - cleaned_calls AS duplicate_rows_removed, answered_calls,
  cleaned_calls - answered_calls AS no_agent_calls, cleaned_calls AS answered_plus_no_agent,
  true AS answered_no_agent_reconciled, 'Orig CallID; keep last row after date filtering' AS dedupe_key,
  'csv_cleaned_queue_level_calls' AS calculation_source FROM qv0)"""


def _qv(spark, sf_dir):
    filtered = filter_period_csv(ctx.legs(spark, sf_dir), ctx.PERIOD_START, ctx.PERIOD_END)
    return V.queue_validation(filtered, curate_csv(dedup_csv(filtered)), ctx.dim(spark))


@register("queue_validation", QV_SQL + "\nSELECT * FROM qv")
def queue_validation(spark, sf_dir):
    """A-14 / J-5: raw vs cleaned rows, duplicates removed, answered + no-agent reconciliation."""
    return _qv(spark, sf_dir)


@register("run_validation", QV_SQL + f"""
SELECT 'success' AS status, CAST(sum(raw_rows) AS BIGINT) AS raw_row_count,
  CAST(sum(cleaned_calls) AS BIGINT) AS cleaned_row_count,
  CAST(sum(raw_rows) - sum(cleaned_calls) AS BIGINT) AS duplicate_rows_removed,
  CAST(sum(answered_calls) AS BIGINT) AS answered_count, CAST(sum(no_agent_calls) AS BIGINT) AS no_agent_count,
  CAST(sum(answered_calls) + sum(no_agent_calls) AS BIGINT) AS answered_plus_no_agent,
  sum(answered_calls) + sum(no_agent_calls) = sum(cleaned_calls) AS answered_plus_no_agent_reconciles,
  '{O.PERIOD_START} 00:00:00 through {O.PERIOD_END} 23:59:59' AS date_range_used,
  'America/Toronto' AS timezone_used, string_agg(queue_id, ',' ORDER BY queue_id) AS queues_included,
  'Orig CallID; keep last row after date filtering' AS dedupe_key_used,
  'csv_cleaned_queue_level_calls' AS calculation_source_used
FROM qv""")
def run_validation(spark, sf_dir):
    """A-17: run totals over the queue validation rows."""
    return V.run_validation(_qv(spark, sf_dir), ctx.PERIOD_START, ctx.PERIOD_END, "America/Toronto")


# A fifth configured queue that has no source rows, so the gap detector has something to find.
GAP_QUEUES = DEFAULT_QUEUES + (Queue("8040", "CSR Callback English", "English", "overflow"),)


@register("source_gaps", f"""WITH {O.LEGS},
dim5 AS (SELECT queue_id FROM {O.DIM} UNION ALL SELECT '8040')
SELECT queue_id, 'missing_csv' AS reason, 'No CSV found for queue ' || queue_id || ' in events' AS message
FROM dim5 WHERE queue_id NOT IN (SELECT DISTINCT queue_id FROM legs)""")
def source_gaps(spark, sf_dir):
    """J-7: configured queues with no source rows."""
    return V.source_gaps(ctx.legs(spark, sf_dir), queue_dim(spark, GAP_QUEUES), "events")


STATS_SQL = f"""WITH {O.LEGS},
stats AS (
  SELECT queue_id, count(*) AS calls_offered,
    count(*) FILTER (WHERE lower(trim(queue_release_reason)) = 'no answer') AS calls_forwarded,
    count(*) FILTER (WHERE lower(trim(queue_release_reason)) = 'abandoned') AS abandoned_calls,
    count(*) FILTER (WHERE agent_time NOT IN ('00:00', '53ms')) AS calls_handled,
    count(DISTINCT orig_call_id) AS call_volume
  FROM legs GROUP BY queue_id)"""


def _stats(spark, sf_dir):
    return S.parse_stats(S.stats_document_from_legs(ctx.legs(spark, sf_dir)))


@register("stats_diagnostics", STATS_SQL + f"""
SELECT s.queue_id, calls_offered, calls_forwarded, abandoned_calls, calls_handled, call_volume,
  least(calls_offered, calls_forwarded + abandoned_calls) AS derived_no_agent_calls,
  greatest(0, calls_offered - least(calls_offered, calls_forwarded + abandoned_calls)) AS derived_handled_calls,
  'Diagnostic only; cleaned queue metrics are not overwritten.' AS note
FROM stats s JOIN {O.DIM} d USING (queue_id)""")
def stats_diagnostics(spark, sf_dir):
    """S-5 + A-23: statistics document parsed back and the derived diagnostics per queue."""
    return S.stats_diagnostics(_stats(spark, sf_dir), ctx.dim(spark))


@register("stats_funnel", STATS_SQL + f""",
b AS (
  SELECT d.language,
    coalesce(sum(CASE WHEN role = 'primary' THEN calls_offered END), 0) AS pc,
    coalesce(sum(CASE WHEN role = 'primary' THEN calls_forwarded + abandoned_calls END), 0) AS pl,
    coalesce(sum(CASE WHEN role = 'overflow' THEN calls_offered END), 0) AS orc,
    coalesce(sum(CASE WHEN role = 'overflow' THEN calls_forwarded + abandoned_calls END), 0) AS ol
  FROM {O.DIM} d LEFT JOIN stats USING (queue_id) GROUP BY d.language),
c AS (SELECT language, pc, orc, least(pc, pl) AS pf, least(orc, ol) AS ofl FROM b),
e AS (SELECT *, greatest(0, pc - pf) AS pa, greatest(0, orc - ofl) AS oa FROM c),
f AS (SELECT *, greatest(0, pf - oa) AS lost FROM e)
SELECT language, CAST(pc AS BIGINT) AS primary_calls, CAST(pa AS BIGINT) AS primary_answered,
  CAST(pf AS BIGINT) AS primary_failed, CAST(pf AS BIGINT) AS primary_no_agent_calls,
  {O.ratio('pf', 'pc')} AS primary_no_agent_rate, CAST(orc AS BIGINT) AS overflow_received,
  {O.ratio('orc', 'pf')} AS routing_match, CAST(oa AS BIGINT) AS overflow_answered,
  CAST(ofl AS BIGINT) AS overflow_failed, CAST(lost AS BIGINT) AS lost, {O.ratio('lost', 'pc')} AS lost_rate,
  CASE WHEN pc <> 0 THEN 1.0 - {O.ratio('lost', 'pc')} ELSE 0.0 END AS effective_answer_rate,
  CAST(pf - orc AS BIGINT) AS unaccounted, true AS final_dropped_available, CAST(lost AS BIGINT) AS final_dropped_calls,
  'final_dropped_after_overflow' AS drop_definition
FROM f""")
def stats_funnel(spark, sf_dir):
    """A-24: statistics funnel per language (lost = max(0, primary failed - overflow answered))."""
    return S.stats_funnel(_stats(spark, sf_dir), ctx.dim(spark))

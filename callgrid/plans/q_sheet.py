"""Query family: cleaned-export sheet variants (S-10, S-11, F-27, A-25, A-26).

The sheet is the period's cleaned legs rendered as text lines per queue: a title line,
a header line (with a duplicated header), a blank line, then one line per call.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from callgrid import oracle as O
from callgrid.functions import exprs as X
from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.operators import sheet as S
from callgrid.operators.curate import filter_period_csv
from callgrid.operators.dedup import dedup_csv
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register

SHEET_HEADERS = ("Queue ID", "Call Time", "Caller Number", "Orig CallID", "Agent Name", "Agent Extension",
                 "Time in Queue", "Agent Time", "Hold Time", "Queue Release Reason", "Agent Release Reason",
                 "Agent Time")
SOURCE_COLUMNS = ("queue_id", "call_time", "caller_number", "orig_call_id", "agent_name", "agent_extension",
                  "time_in_queue", "agent_time", "hold_time", "queue_release_reason", "agent_release_reason",
                  "agent_time")
REQUIRED = [("Queue ID", "Call Time", "Caller Number", "Orig CallID")]


def sheet_lines(spark, sf_dir):
    """The per-queue text sheets (one line = an array of cells)."""
    legs = dedup_csv(filter_period_csv(ctx.legs(spark, sf_dir), ctx.PERIOD_START, ctx.PERIOD_END))
    data = legs.select(F.col("queue_id").alias("sheet"), (F.col("leg_no") + 10).alias("line_no"),
                       F.array(*[F.col(c).cast("string") for c in SOURCE_COLUMNS]).alias("cells"))
    n = len(SHEET_HEADERS)
    dim = ctx.dim(spark).select(F.col("queue_id").alias("sheet"))
    title = dim.select("sheet", F.lit(0).cast("bigint").alias("line_no"),
                       F.array(F.lit("Cleaned Data"), *[F.lit(None).cast("string")] * (n - 1)).alias("cells"))
    header = dim.select("sheet", F.lit(1).cast("bigint").alias("line_no"),
                        F.array(*[F.lit(h) for h in SHEET_HEADERS]).alias("cells"))
    blank = dim.select("sheet", F.lit(2).cast("bigint").alias("line_no"),
                       F.array(*[F.lit(None).cast("string")] * n).alias("cells"))
    return title.unionByName(header).unionByName(blank).unionByName(data)


def sheet_calls(spark, sf_dir):
    recs = S.detect_header(sheet_lines(spark, sf_dir), REQUIRED)
    return S.sheet_curated(recs, ctx.dim(spark))


def _ss(x: str) -> str:
    t = O.trim_ws(x)
    return (f"coalesce(TRY_CAST({t} AS DOUBLE), CASE WHEN regexp_full_match({t}, '[0-9]+:[0-9]+') THEN "
            f"CAST(CAST(split_part({t}, ':', 1) AS BIGINT) * 60 + CAST(split_part({t}, ':', 2) AS BIGINT) AS DOUBLE) "
            f"WHEN regexp_full_match({t}, '[0-9]+:[0-9]+:[0-9]+') THEN CAST(CAST(split_part({t}, ':', 1) AS BIGINT) * 3600 "
            f"+ CAST(split_part({t}, ':', 2) AS BIGINT) * 60 + CAST(split_part({t}, ':', 3) AS BIGINT) AS DOUBLE) END, 0.0)")


def _st(x: str) -> str:
    t = O.trim_ws(x)
    return f"(CASE WHEN {t} <> '' AND lower({t}) <> 'null' THEN {t} END)"


SHEET_CTE = O.curated_ctes() + f""",
sheet AS (
  SELECT d.queue_id, q.queue_name, q.language, q.role, orig_call_id AS call_id, call_dt AS call_datetime,
    CAST(call_dt AS DATE) AS date, CAST(hour(call_dt) AS INTEGER) AS hour, strftime(call_dt, '%A') AS dow,
    CASE WHEN {_st('caller_number')} IS NULL THEN 'Unknown' WHEN lower({_st('caller_number')}) = 'restricted'
         THEN 'Restricted' WHEN regexp_replace({_st('caller_number')}, '[^0-9]+', '', 'g') <> ''
         THEN regexp_replace({_st('caller_number')}, '[^0-9]+', '', 'g') ELSE {_st('caller_number')} END
      AS caller_number_norm,
    {_st('agent_name')} AS agent_name, {_st('agent_extension')} AS agent_extension,
    {_ss('time_in_queue')} AS queue_sec, {_ss('agent_time')} AS agent_sec, {_ss('hold_time')} AS hold_sec,
    {_st('queue_release_reason')} AS queue_release_reason, {_st('agent_release_reason')} AS agent_release_reason,
    {_ss('agent_time')} > 0 AS is_handled
  FROM deduped d JOIN {O.DIM} q USING (queue_id))"""

SHEET_COLS = ("queue_id, queue_name, language, role, call_id, call_datetime, date, hour, dow, caller_number_norm, "
              "agent_name, agent_extension, queue_sec, agent_sec, hold_sec, queue_release_reason, agent_release_reason")


@register("sheet_calls", SHEET_CTE + f"\nSELECT {SHEET_COLS} FROM sheet", dates=("date",))
def sheet_calls_q(spark, sf_dir):
    """S-10 + S-11 + F-27: header found in the text sheet, rows mapped to curated calls."""
    return sheet_calls(spark, sf_dir).drop("is_handled")


@register("sheet_headline", SHEET_CTE + f"""
, agg AS (SELECT queue_id, count(*) AS total_calls, count(*) FILTER (WHERE is_handled) AS handled_calls,
          count(DISTINCT date) AS days_with_calls FROM sheet GROUP BY 1)
SELECT d.queue_id, coalesce(total_calls, 0) AS total_calls, coalesce(handled_calls, 0) AS handled_calls,
  coalesce(total_calls, 0) - coalesce(handled_calls, 0) AS no_agent_calls,
  {O.ratio('coalesce(handled_calls, 0)', 'coalesce(total_calls, 0)')} AS answer_rate,
  {O.ratio('coalesce(total_calls, 0) - coalesce(handled_calls, 0)', 'coalesce(total_calls, 0)')} AS no_agent_rate,
  coalesce(days_with_calls, 0) AS days_with_calls,
  {O.ratio('coalesce(total_calls, 0)', 'coalesce(days_with_calls, 0)')} AS avg_calls_per_active_day
FROM {O.DIM} d LEFT JOIN agg USING (queue_id)""")
def sheet_headline(spark, sf_dir):
    """A-25: headline of the sheet calls (handled = agent seconds > 0)."""
    return C.headline(C.calls_cube(sheet_calls(spark, sf_dir)), ctx.dim(spark))


@register("sheet_top_callers", SHEET_CTE + """
, c AS (SELECT queue_id, caller_number_norm, count(*) AS calls FROM sheet GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY queue_id ORDER BY calls DESC, caller_number_norm)
  AS INTEGER) AS rank FROM c) WHERE rank <= 100""")
def sheet_top_callers(spark, sf_dir):
    """A-25: top 100 callers per queue, Unknown / Restricted included."""
    return S.sheet_top_callers(sheet_calls(spark, sf_dir), 100)


@register("sheet_release_reasons", SHEET_CTE + """
, l AS (SELECT queue_id, 'queue' AS reason_type, coalesce(queue_release_reason, '(blank)') AS reason FROM sheet
        UNION ALL SELECT queue_id, 'agent', coalesce(agent_release_reason, '(blank)') FROM sheet),
c AS (SELECT queue_id, reason_type, reason, count(*) AS calls FROM l GROUP BY 1, 2, 3)
SELECT *, CAST(row_number() OVER (PARTITION BY queue_id, reason_type ORDER BY calls DESC, reason) AS INTEGER) AS rank
FROM c""")
def sheet_release_reasons(spark, sf_dir):
    """A-25: reasons with blanks counted as "(blank)"."""
    return S.sheet_reasons(sheet_calls(spark, sf_dir))


@register("sheet_funnel", SHEET_CTE + f"""
, b AS (SELECT language,
    count(*) FILTER (WHERE role = 'primary') AS pc, count(*) FILTER (WHERE role = 'primary' AND is_handled) AS pa,
    count(*) FILTER (WHERE role = 'overflow') AS orc, count(*) FILTER (WHERE role = 'overflow' AND is_handled) AS oa
  FROM sheet GROUP BY language),
f AS (SELECT *, pc - pa AS pf, orc - oa AS ofl FROM b)
SELECT language, pc AS primary_calls, pa AS primary_answered, pf AS primary_failed, pf AS primary_no_agent_calls,
  {O.ratio('pf', 'pc')} AS primary_no_agent_rate, orc AS overflow_received, {O.ratio('orc', 'pf')} AS routing_match,
  oa AS overflow_answered, ofl AS overflow_failed, ofl AS lost, {O.ratio('ofl', 'pc')} AS lost_rate,
  CASE WHEN pc <> 0 THEN 1.0 - {O.ratio('ofl', 'pc')} ELSE 0.0 END AS effective_answer_rate,
  pf - orc AS unaccounted, true AS final_dropped_available, ofl AS final_dropped_calls,
  'final_dropped_after_overflow' AS drop_definition
FROM f""")
def sheet_funnel(spark, sf_dir):
    """A-25: funnel that is always "available" (lost = overflow failed)."""
    return S.sheet_funnel(C.calls_cube(sheet_calls(spark, sf_dir)))


@register("sheet_consolidated_agents", SHEET_CTE + """
, lb AS (SELECT queue_id, agent_name, count(*) AS calls FROM sheet WHERE is_handled AND agent_name IS NOT NULL
         GROUP BY 1, 2)
SELECT agent_name, """ + ", ".join(
    f"CAST(coalesce(sum(calls) FILTER (WHERE queue_id = '{q}'), 0) AS BIGINT) AS \"{q}\"" for q in ctx.QUEUE_IDS)
    + ", CAST(sum(calls) AS BIGINT) AS total_calls FROM lb GROUP BY agent_name")
def sheet_consolidated_agents(spark, sf_dir):
    """A-25: consolidated agents built from the per-queue leaderboards."""
    return S.consolidated_from_leaderboards(S.sheet_leaderboard(sheet_calls(spark, sf_dir)), ctx.QUEUE_IDS)


@register("supplied_summary_override", SHEET_CTE + """
, lb AS (
  SELECT queue_id, agent_name, count(call_id) AS calls, avg(agent_sec) AS avg_sec,
    quantile_cont(agent_sec, 0.5) AS median_sec, sum(agent_sec) AS total_sec
  FROM curated WHERE is_handled AND coalesce(""" + O.has_value('agent_name') + """, false)
  GROUP BY queue_id, agent_name),
supplied AS (SELECT *, CAST(calls AS DOUBLE) / sum(calls) OVER (PARTITION BY queue_id) AS pct_of_answered,
  'supplied' AS source FROM lb WHERE queue_id IN ('8020', '8021')),
slb AS (SELECT queue_id, agent_name, count(*) AS calls, avg(agent_sec) AS avg_sec,
    quantile_cont(agent_sec, 0.5) AS median_sec, sum(agent_sec) AS total_sec
  FROM sheet WHERE is_handled AND agent_name IS NOT NULL GROUP BY 1, 2),
computed AS (SELECT *, CAST(calls AS DOUBLE) / sum(calls) OVER (PARTITION BY queue_id) AS pct_of_answered,
  'computed' AS source FROM slb)
SELECT * FROM computed WHERE queue_id NOT IN (SELECT DISTINCT queue_id FROM supplied)
UNION ALL SELECT * FROM supplied""")
def supplied_summary_override(spark, sf_dir):
    """A-26: a supplied leaderboard (here: the CSV-path leaderboard of the primary queues)
    replaces the computed sheet leaderboard for the queues it covers."""
    computed = S.sheet_leaderboard(sheet_calls(spark, sf_dir)).withColumn("source", F.lit("computed"))
    supplied = (M.agent_leaderboard(ctx.curated(spark, sf_dir)).filter(F.col("queue_id").isin("8020", "8021"))
                .drop("rank").withColumn("source", F.lit("supplied")))
    return S.supplied_override(computed, supplied)


@register("sheet_distribution", SHEET_CTE + f"""
, m AS (SELECT queue_id, 'queue_sec' AS measure, queue_sec AS v FROM sheet
        UNION ALL SELECT queue_id, 'agent_sec', agent_sec FROM sheet WHERE agent_sec > 0
        UNION ALL SELECT queue_id, 'hold_sec', hold_sec FROM sheet WHERE hold_sec > 0)
SELECT d.queue_id, x.measure, count(v) AS count, avg(v) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
  quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS p75, max(v) AS max
FROM {O.DIM} d CROSS JOIN (VALUES ('queue_sec'), ('agent_sec'), ('hold_sec')) AS x(measure)
LEFT JOIN m ON m.queue_id = d.queue_id AND m.measure = x.measure GROUP BY 1, 2""")
def sheet_distribution(spark, sf_dir):
    """A-25: duration statistics of the sheet calls (std rounded to 6 places)."""
    return S.sheet_distribution(sheet_calls(spark, sf_dir), ctx.dim(spark)).withColumn("std", F.round("std", 6))


@register("sheet_weekly", SHEET_CTE + """
SELECT queue_id, CAST(date_trunc('week', date) AS DATE) AS week_start, CAST(date_trunc('week', date) AS DATE) + 6 AS week_end,
  count(*) AS calls FROM sheet GROUP BY 1, 2, 3""", dates=("week_start", "week_end"))
def sheet_weekly(spark, sf_dir):
    """A-25: weekly volume of the sheet calls."""
    return C.weekly_volume(C.calls_cube(sheet_calls(spark, sf_dir)))


@register("sheet_hourly", SHEET_CTE + f"""
SELECT queue_id, hour, count(*) AS calls, count(*) FILTER (WHERE NOT is_handled) AS no_answer_count,
  {O.ratio('count(*) FILTER (WHERE NOT is_handled)', 'count(*)')} AS no_answer_rate,
  avg(agent_sec) FILTER (WHERE is_handled) AS avg_agent_sec FROM sheet GROUP BY 1, 2""")
def sheet_hourly(spark, sf_dir):
    """A-25: hourly volume, no-answer rate and mean handled seconds of the sheet calls."""
    return C.hourly_volume(C.calls_cube(sheet_calls(spark, sf_dir)))


@register("sheet_callers", SHEET_CTE + "\nSELECT caller_number_norm, " + ", ".join(
    f"count(*) FILTER (WHERE queue_id = '{q}') AS \"{q}\"" for q in ctx.QUEUE_IDS) + ", count(*) AS total_calls FROM sheet GROUP BY 1")
def sheet_callers(spark, sf_dir):
    """A-25: caller pivot with Unknown and Restricted."""
    return S.sheet_callers(sheet_calls(spark, sf_dir), ctx.QUEUE_IDS)


@register("supplied_reasons_override", SHEET_CTE + f"""
, l AS (SELECT queue_id, 'queue' AS reason_type, coalesce(queue_release_reason, '(blank)') AS reason FROM sheet
        UNION ALL SELECT queue_id, 'agent', coalesce(agent_release_reason, '(blank)') FROM sheet),
supplied AS (SELECT queue_id, 'queue' AS reason_type, {O.trim_ws('queue_release_reason')} AS reason, count(*) AS calls FROM curated
  WHERE queue_id IN ('8020', '8021') AND coalesce({O.has_value('queue_release_reason')}, false) GROUP BY 1, 2, 3)
SELECT queue_id, reason_type, reason, count(*) AS calls FROM l
WHERE (queue_id, reason_type) NOT IN (SELECT (queue_id, reason_type) FROM supplied) GROUP BY 1, 2, 3
UNION ALL SELECT * FROM supplied""")
def supplied_reasons_override(spark, sf_dir):
    """A-26: supplied queue reasons (here: the CSV path's, of the primary queues) replace the computed ones of their queue
    and type; the agent reasons stay computed."""
    computed = S.sheet_reasons(sheet_calls(spark, sf_dir)).drop("rank")
    supplied = M.release_reasons(ctx.curated(spark, sf_dir)).where(F.col("queue_id").isin("8020", "8021") & (F.col("reason_type") == "queue"))
    return S.supplied_override(computed, supplied, ("queue_id", "reason_type"))


@register("supplied_callers_override", SHEET_CTE + """
, c AS (SELECT queue_id, caller_number_norm, count(*) AS calls FROM sheet GROUP BY 1, 2),
computed AS (SELECT queue_id, caller_number_norm, calls FROM (SELECT *, row_number() OVER (
  PARTITION BY queue_id ORDER BY calls DESC, caller_number_norm) AS rank FROM c) WHERE rank <= 100),
supplied AS (SELECT queue_id, caller_number_norm, count(*) AS calls FROM curated
  WHERE queue_id = '8030' AND NOT starts_with(caller_number_norm, '__restricted__') GROUP BY 1, 2 HAVING count(*) > 1)
SELECT * FROM computed WHERE queue_id <> '8030' OR (SELECT count(*) FROM supplied) = 0 UNION ALL SELECT * FROM supplied""")
def supplied_callers_override(spark, sf_dir):
    """A-26: a supplied list of repeat callers (here: one overflow queue's of the CSV path) replaces the computed top callers."""
    computed = S.sheet_top_callers(sheet_calls(spark, sf_dir), 100).drop("rank")
    known = ctx.curated(spark, sf_dir).where((F.col("queue_id") == "8030") & ~X.is_restricted("caller_number_norm"))
    supplied = known.groupBy("queue_id", "caller_number_norm").agg(F.count(F.lit(1)).alias("calls")).where("calls > 1")
    return S.supplied_override(computed, supplied)

"""Query family: per-queue distributions, reasons, leaderboards, callers, summary card, sparkline.

A-7…A-10, A-20, W-3, W-5, W-6, O-1, O-3.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from callgrid import oracle as O
from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.plans.q_core import HEADLINE_SQL

DIST_SQL = O.with_curated(f""",
long AS (
  SELECT queue_id, 'queue_sec' AS measure, queue_sec AS value FROM curated WHERE queue_sec IS NOT NULL
  UNION ALL
  SELECT queue_id, 'agent_sec', agent_sec FROM curated
  WHERE is_handled AND coalesce({O.has_value('agent_name')}, false) AND agent_sec IS NOT NULL
  UNION ALL
  SELECT queue_id, 'hold_sec', hold_sec FROM curated WHERE coalesce(hold_sec, 0) > 0),
stats AS (
  SELECT queue_id, measure, count(value) AS count, avg(value) AS mean,
    CASE WHEN count(value) > 1 THEN round(stddev_samp(value), 6) END AS std, min(value) AS min,
    quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS p75,
    max(value) AS max
  FROM long GROUP BY queue_id, measure),
grid AS (SELECT d.queue_id, m.measure FROM {O.DIM} d, (VALUES ('queue_sec'), ('agent_sec'), ('hold_sec')) m(measure))
SELECT g.queue_id, g.measure, coalesce(s.count, 0) AS count, s.mean, s.std, s.min, s.p25, s.median, s.p75, s.max
FROM grid g LEFT JOIN stats s USING (queue_id, measure)""")


@register("duration_distribution", DIST_SQL)
def duration_distribution(spark, sf_dir):
    """A-7 (std rounded to 6 places for the cross-engine comparison)."""
    d = M.duration_distribution(ctx.curated(spark, sf_dir), ctx.dim(spark))
    return d.withColumn("std", F.round("std", 6))


REASONS_SQL = O.with_curated(f""",
long AS (
  SELECT queue_id, 'queue' AS reason_type, queue_release_reason AS raw FROM curated
  UNION ALL SELECT queue_id, 'agent', agent_release_reason FROM curated),
counted AS (
  SELECT queue_id, reason_type, {O.trim_ws('raw')} AS reason, count(*) AS calls FROM long
  WHERE raw IS NOT NULL AND {O.trim_ws('raw')} <> '' AND lower({O.trim_ws('raw')}) <> 'null'
  GROUP BY 1, 2, 3)
SELECT *, CAST(row_number() OVER (PARTITION BY queue_id, reason_type ORDER BY calls DESC, reason ASC) AS INTEGER) AS rank
FROM counted""")


@register("release_reasons", REASONS_SQL)
def release_reasons(spark, sf_dir):
    """A-8: trimmed reasons, blanks and "null" removed; calls desc, reason asc (rank)."""
    return M.release_reasons(ctx.curated(spark, sf_dir))


LEADERBOARD_CTE = f""",
lb AS (
  SELECT queue_id, agent_name, count(call_id) AS calls, avg(agent_sec) AS avg_sec,
    quantile_cont(agent_sec, 0.5) AS median_sec, sum(agent_sec) AS total_sec
  FROM curated WHERE is_handled AND coalesce({O.has_value('agent_name')}, false)
  GROUP BY queue_id, agent_name),
leaderboard AS (
  SELECT *, CAST(calls AS DOUBLE) / sum(calls) OVER (PARTITION BY queue_id) AS pct_of_answered,
    CAST(row_number() OVER (PARTITION BY queue_id ORDER BY calls DESC, agent_name ASC) AS INTEGER) AS rank
  FROM lb)"""


@register("agent_leaderboard", O.with_curated(LEADERBOARD_CTE + "\nSELECT * FROM leaderboard"))
def agent_leaderboard(spark, sf_dir):
    """A-9 + W-3: per-agent calls, mean/median/total seconds and share of the queue's answered calls."""
    return M.agent_leaderboard(ctx.curated(spark, sf_dir))


TOP_CALLERS_CTE = """,
cc AS (
  SELECT queue_id, caller_number_norm, count(*) AS calls FROM curated
  WHERE caller_number_norm IS NOT NULL AND NOT starts_with(caller_number_norm, '__restricted__:')
  GROUP BY 1, 2),
topc AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY queue_id ORDER BY calls DESC, caller_number_norm ASC)
                             AS INTEGER) AS rank FROM cc) WHERE rank <= 10)"""


@register("top_callers", O.with_curated(TOP_CALLERS_CTE + "\nSELECT * FROM topc"))
def top_callers(spark, sf_dir):
    """A-10: 10 most frequent non-restricted callers per queue."""
    return M.top_callers(ctx.curated(spark, sf_dir), 10)


@register("queue_summary", O.with_curated(HEADLINE_SQL + LEADERBOARD_CTE + TOP_CALLERS_CTE + f""",
hourly AS (SELECT queue_id, hour, count(call_id) AS calls FROM curated GROUP BY 1, 2),
peak AS (SELECT queue_id, arg_max(hour, calls * 100 - hour) AS busiest_hour FROM hourly GROUP BY 1)
SELECT h.queue_id, h.total_calls, h.no_agent_rate, p.busiest_hour,
  coalesce(a.agent_name, 'n/a') AS top_agent, coalesce(c.caller_number_norm, 'n/a') AS top_caller
FROM headline h LEFT JOIN peak p USING (queue_id)
LEFT JOIN (SELECT * FROM leaderboard WHERE rank = 1) a USING (queue_id)
LEFT JOIN (SELECT * FROM topc WHERE rank = 1) c USING (queue_id)"""))
def queue_summary(spark, sf_dir):
    """A-20 / W-5: the queue card."""
    cur = ctx.curated_shared(spark, sf_dir)
    cube = ctx.cube_shared(spark, sf_dir)
    return M.queue_summary(C.headline(cube, ctx.dim(spark)), C.hourly_volume(cube, with_avg=False),
                           M.agent_leaderboard(cur), M.top_callers(cur, 1))


@register("sparkline", O.with_curated("""
, daily AS (SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY 1, 2),
s AS (
  SELECT queue_id, date, calls,
    CAST(row_number() OVER (PARTITION BY queue_id ORDER BY date) AS INTEGER) AS pos,
    greatest(10.0, CAST(calls AS DOUBLE) / greatest(max(calls) OVER (PARTITION BY queue_id), 1) * 100.0) AS height_pct
  FROM daily)
SELECT * FROM s WHERE pos <= 30"""), dates=("date",))
def sparkline(spark, sf_dir):
    """W-6: first 30 days per queue as a share of its busiest day, floor 10 %."""
    return M.sparkline(C.daily_volume(ctx.cube(spark, sf_dir)))

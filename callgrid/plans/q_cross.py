"""Query family: cross-queue pivots, overlays and funnel views.

A-12, A-13, A-15, A-16, P-16, P-17, J-9, J-10, W-4, X-1, X-2.
"""

from __future__ import annotations

from callgrid import oracle as O
from callgrid.operators import cross as X
from callgrid.operators import cube as C
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.plans.q_core import FUNNEL_SQL

IDS = ctx.QUEUE_IDS


def _pivot_sql(key: str, where: str) -> str:
    cols = ", ".join(f"count(call_id) FILTER (WHERE queue_id = '{q}') AS \"{q}\"" for q in IDS)
    return (f"SELECT {key}, {cols}, count(call_id) AS total_calls FROM curated "
            f"WHERE {where} AND queue_id IN ({', '.join(repr(q) for q in IDS)}) GROUP BY {key}")


AGENTS_SQL = _pivot_sql("agent_name", "is_handled AND agent_name IS NOT NULL")
CALLERS_SQL = _pivot_sql("caller_number_norm",
                         "caller_number_norm IS NOT NULL AND NOT starts_with(caller_number_norm, '__restricted__:')")


@register("consolidated_agents", O.with_curated(AGENTS_SQL))
def consolidated_agents(spark, sf_dir):
    """A-12: handled calls per agent pivoted by queue + total."""
    return X.consolidated_agents(ctx.curated(spark, sf_dir), IDS)


@register("consolidated_callers", O.with_curated(CALLERS_SQL))
def consolidated_callers(spark, sf_dir):
    """A-13: calls per caller pivoted by queue + total (restricted excluded)."""
    return X.consolidated_callers(ctx.curated(spark, sf_dir), IDS)


@register("multi_queue_callers", O.with_curated(
    f", p AS ({CALLERS_SQL})\nSELECT * FROM p WHERE " + " + ".join(f'(CASE WHEN "{q}" > 0 THEN 1 ELSE 0 END)' for q in IDS)
    + " >= 2"))
def multi_queue_callers(spark, sf_dir):
    """P-16: callers seen on two or more queues."""
    return X.multi_queue_callers(X.consolidated_callers(ctx.curated(spark, sf_dir), IDS), IDS)


SAME_HOUR_SQL = f"""SELECT queue_id, hour, count(call_id) AS calls, count(*) FILTER (WHERE NOT is_handled) AS no_answer_count,
  {O.ratio('count(*) FILTER (WHERE NOT is_handled)', 'count(call_id)')} AS no_answer_rate
FROM curated GROUP BY queue_id, hour"""


@register("same_hour_no_answer", O.with_curated(SAME_HOUR_SQL))
def same_hour_no_answer(spark, sf_dir):
    """A-15: no-answer rate per (queue, hour) across queues."""
    return C.hourly_volume(ctx.cube(spark, sf_dir), with_avg=False)


@register("same_hour_grid", O.with_curated(f""", sh AS ({SAME_HOUR_SQL}),
grid AS (SELECT d.queue_id, CAST(h.hour AS INTEGER) AS hour FROM {O.DIM} d, range(24) h(hour))
SELECT g.queue_id, g.hour, coalesce(sh.no_answer_rate, 0.0) AS no_answer_rate
FROM grid g LEFT JOIN sh USING (queue_id, hour)"""))
def same_hour_grid(spark, sf_dir):
    """J-9: dense 24-hour x queue grid of no-answer rates (0 where no call)."""
    return X.same_hour_grid(C.hourly_volume(ctx.cube(spark, sf_dir), with_avg=False), ctx.dim(spark))


@register("same_day_volume", O.with_curated(
    "SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY queue_id, date"), dates=("date",))
def same_day_volume(spark, sf_dir):
    """A-16: calls per (queue, date) across queues."""
    return C.daily_volume(ctx.cube(spark, sf_dir))


@register("same_day_pivot", O.with_curated(
    "SELECT date, " + ", ".join(f"CAST(sum(CASE WHEN queue_id = '{q}' THEN 1 END) AS BIGINT) AS \"{q}\"" for q in IDS)
    + " FROM curated GROUP BY date"), dates=("date",))
def same_day_pivot(spark, sf_dir):
    """J-10: date x queue calls for the overlay."""
    return X.same_day_pivot(C.daily_volume(ctx.cube(spark, sf_dir)), IDS)


@register("same_day_normalized", O.with_curated("""
, daily AS (SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY queue_id, date)
SELECT queue_id, date, CASE WHEN max(calls) OVER (PARTITION BY queue_id) > 0
  THEN CAST(calls AS DOUBLE) / max(calls) OVER (PARTITION BY queue_id) ELSE 0.0 END AS normalized_calls
FROM daily"""), dates=("date",))
def same_day_normalized(spark, sf_dir):
    """W-4: each day relative to the queue's busiest day."""
    return X.same_day_normalized(C.daily_volume(ctx.cube(spark, sf_dir)))


@register("funnel_slices", O.with_curated(FUNNEL_SQL + """
, sl AS (
  SELECT language, 'answered_primary' AS slice, primary_answered AS value FROM funnel
  UNION ALL SELECT language, 'answered_overflow', overflow_answered FROM funnel
  UNION ALL SELECT language, 'never_connected', lost FROM funnel
  UNION ALL SELECT language, 'untracked', unaccounted FROM funnel)
SELECT * FROM sl WHERE value > 0"""))
def funnel_slices(spark, sf_dir):
    """P-17: positive funnel slices per language."""
    return X.funnel_slices(X.language_funnel(ctx.cube(spark, sf_dir), ctx.dim(spark)))


def _daily_funnel_sql() -> str:
    body = FUNNEL_SQL.replace("FROM curated GROUP BY language", "FROM curated GROUP BY language, date") \
        .replace("SELECT language,\n    count(*) FILTER (WHERE role = 'primary') AS primary_calls",
                 "SELECT language, date,\n    count(*) FILTER (WHERE role = 'primary') AS primary_calls")
    body = body.replace(
        f"""  SELECT l.language, coalesce(primary_calls, 0) AS pc, coalesce(primary_answered, 0) AS pa,
    coalesce(overflow_received, 0) AS orc, coalesce(overflow_answered, 0) AS oa
  FROM (SELECT DISTINCT language FROM {O.DIM}) l LEFT JOIN fb USING (language)),""",
        """  SELECT language, date, primary_calls AS pc, primary_answered AS pa,
    overflow_received AS orc, overflow_answered AS oa FROM fb),""")
    body = body.replace("  SELECT language, pc AS primary_calls", "  SELECT language, date, pc AS primary_calls")
    return body


@register("effective_rate_daily", O.with_curated(_daily_funnel_sql() + "\nSELECT * FROM funnel"), dates=("date",))
def effective_rate_daily(spark, sf_dir):
    """X-1: the language funnel per day (effective answer rate over time)."""
    return X.effective_rate_daily(ctx.cube(spark, sf_dir))


@register("daily_no_answer", O.with_curated(f"""SELECT queue_id, date, count(*) AS calls,
  count(*) FILTER (WHERE NOT is_handled) AS no_answer_count,
  {O.ratio('count(*) FILTER (WHERE NOT is_handled)', 'count(*)')} AS no_answer_rate
FROM curated GROUP BY queue_id, date"""), dates=("date",))
def daily_no_answer(spark, sf_dir):
    """X-2: daily no-answer next to daily volume."""
    return C.daily_volume(ctx.cube(spark, sf_dir), with_no_answer=True)


@register("global_top", O.with_curated(f""", a AS ({AGENTS_SQL}), c AS ({CALLERS_SQL}),
ta AS (SELECT 'agent' AS kind, agent_name AS name, total_calls FROM a ORDER BY total_calls DESC, agent_name LIMIT 1),
tc AS (SELECT 'caller' AS kind, caller_number_norm AS name, total_calls FROM c
       ORDER BY total_calls DESC, caller_number_norm LIMIT 1)
SELECT * FROM ta UNION ALL SELECT * FROM tc"""))
def global_top(spark, sf_dir):
    """O-4: the single busiest agent and caller across queues (total desc, name asc)."""
    from callgrid.operators.ordering import count_then_name, top_k
    cur = ctx.curated_shared(spark, sf_dir)
    a = top_k(X.consolidated_agents(cur, IDS), count_then_name("total_calls", "agent_name"), 1)
    c = top_k(X.consolidated_callers(cur, IDS), count_then_name("total_calls", "caller_number_norm"), 1)
    from pyspark.sql import functions as F
    return (a.select(F.lit("agent").alias("kind"), F.col("agent_name").alias("name"), "total_calls")
            .unionByName(c.select(F.lit("caller").alias("kind"), F.col("caller_number_norm").alias("name"),
                                  "total_calls")))

"""Query family: dedup, parsing, curation, headline and volume roll-ups.

W-1, W-2 (call-key form), P-1, P-2, F-1…F-8, P-12, A-1…A-6, A-21 and the flagship.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from callgrid import oracle as O
from callgrid.functions import exprs as X
from callgrid.operators import cube as C
from callgrid.operators.cross import language_funnel
from callgrid.operators.curate import filter_period, filter_period_csv, with_call_datetime
from callgrid.operators.dedup import dedup_csv, keep_last
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register

# --- dedup and period filters (T2, T3, T4) -----------------------------------------------

@register("dedup_keep_last", f"""WITH {O.LEGS}
SELECT queue_id, orig_call_id, leg_no, call_time FROM legs
QUALIFY row_number() OVER (PARTITION BY queue_id, orig_call_id ORDER BY leg_no DESC) = 1""")
def dedup_keep_last(spark, sf_dir):
    """W-1: last leg in file order per (queue, call id), over all legs."""
    return dedup_csv(ctx.legs(spark, sf_dir)).select("queue_id", "orig_call_id", "leg_no", "call_time")


@register("filter_then_dedup", f"""WITH {O.LEGS}
SELECT queue_id, orig_call_id, leg_no FROM legs
WHERE CAST(strptime(call_time, '%m/%d/%Y %I:%M %p') AS DATE) BETWEEN DATE '{O.PERIOD_START}' AND DATE '{O.HALF_END}'
QUALIFY row_number() OVER (PARTITION BY queue_id, orig_call_id ORDER BY leg_no DESC) = 1""")
def filter_then_dedup(spark, sf_dir):
    """P-1 then W-1 (CSV order): the period filter runs before the dedup."""
    legs = filter_period_csv(ctx.legs(spark, sf_dir), ctx.PERIOD_START, ctx.HALF_END)
    return dedup_csv(legs).select("queue_id", "orig_call_id", "leg_no")


@register("dedup_then_filter", f"""WITH {O.LEGS},
last AS (SELECT * FROM legs QUALIFY row_number() OVER (PARTITION BY orig_call_id ORDER BY leg_no DESC) = 1)
SELECT orig_call_id, queue_id, leg_no FROM last
WHERE CAST(strptime(call_time, '%m/%d/%Y %I:%M %p') AS DATE) BETWEEN DATE '{O.PERIOD_START}' AND DATE '{O.HALF_END}'""")
def dedup_then_filter(spark, sf_dir):
    """Global keep-last on the call key (API order), then P-2: a late leg outside the period drops the call."""
    last = keep_last(ctx.legs(spark, sf_dir), ["orig_call_id"], [F.col("leg_no").desc()])
    last = with_call_datetime(last)
    return filter_period(last, ctx.PERIOD_START, ctx.HALF_END, ts="_call_dt").select(
        "orig_call_id", "queue_id", "leg_no")


# --- scalar functions over every leg -------------------------------------------------------

@register("parse_durations", f"""WITH {O.LEGS}
SELECT leg_no, {O.to_seconds('time_in_queue')} AS queue_sec, {O.to_seconds('agent_time')} AS agent_sec,
  {O.to_seconds('hold_time')} AS hold_sec FROM legs""")
def parse_durations(spark, sf_dir):
    """F-1 over all legs (``53ms`` -> null)."""
    legs = ctx.legs(spark, sf_dir)
    return legs.select("leg_no", X.to_seconds("time_in_queue").alias("queue_sec"),
                       X.to_seconds("agent_time").alias("agent_sec"), X.to_seconds("hold_time").alias("hold_sec"))


@register("parse_call_time", f"""WITH {O.LEGS}
SELECT leg_no, strptime(call_time, '%m/%d/%Y %I:%M %p') AS call_datetime,
  CAST(strptime(call_time, '%m/%d/%Y %I:%M %p') AS DATE) AS date,
  CAST(hour(strptime(call_time, '%m/%d/%Y %I:%M %p')) AS INTEGER) AS hour,
  strftime(strptime(call_time, '%m/%d/%Y %I:%M %p'), '%A') AS dow FROM legs""", dates=("date",))
def parse_call_time(spark, sf_dir):
    """F-2 + F-5: wall-clock timestamp, date, hour, English weekday."""
    ts = X.parse_call_time("call_time")
    return ctx.legs(spark, sf_dir).select("leg_no", ts.alias("call_datetime"), F.to_date(ts).alias("date"),
                                          F.hour(ts).alias("hour"), X.day_name(ts).alias("dow"))


@register("normalize_callers", f"""WITH {O.LEGS}
SELECT leg_no, caller_number, {O.normalize_caller('caller_number', 'orig_call_id')} AS caller_number_norm FROM legs""")
def normalize_callers(spark, sf_dir):
    """F-3 / F-4: digits only, restricted and missing callers get a per-call sentinel."""
    return ctx.legs(spark, sf_dir).select(
        "leg_no", "caller_number", X.normalize_caller("caller_number", "orig_call_id").alias("caller_number_norm"))


def _no_agent_sql(*cols):
    return "(" + " OR ".join(
        f"lower({O.trim_ws(f'coalesce({c}, {chr(39)}{chr(39)})')}) IN ('abandoned', 'no answer', 'not available')"
        for c in cols) + ")"


@register("clean_text", f"""WITH {O.LEGS}
SELECT leg_no, {O.clean_text('agent_name')} AS agent_name_clean,
  {O.clean_text('queue_release_reason')} AS queue_reason_clean,
  coalesce({O.has_value('agent_name')}, false) AS agent_name_valid,
  {_no_agent_sql('queue_release_reason', 'agent_release_reason')} AS no_agent_release
FROM legs""")
def clean_text(spark, sf_dir):
    """F-7 / F-8 / P-6 / P-7 over all legs."""
    return ctx.legs(spark, sf_dir).select(
        "leg_no", X.clean_text("agent_name").alias("agent_name_clean"),
        X.clean_text("queue_release_reason").alias("queue_reason_clean"),
        X.valid_agent_name("agent_name").alias("agent_name_valid"),
        X.no_agent_release("queue_release_reason", "agent_release_reason").alias("no_agent_release"))


CURATED_SELECT = ", ".join(
    ["queue_id", "queue_name", "language", "role", "call_id", "call_time", "call_datetime", "date", "hour", "dow",
     "caller_name", "caller_number", "caller_number_norm", "dnis", "agent_extension", "agent_phone", "agent_name",
     "queue_sec", "agent_sec", "hold_sec", "agent_release_reason", "queue_release_reason", "handled_flag"])


@register("curated_calls", O.with_curated(f"SELECT {CURATED_SELECT} FROM curated"), dates=("date",))
def curated_calls(spark, sf_dir):
    """P-12: the 23-column curated table for the period."""
    return ctx.curated(spark, sf_dir).drop("is_handled")


# --- headline and volume roll-ups ----------------------------------------------------------

HEADLINE_SQL = f""",
agg AS (SELECT queue_id, count(*) AS total_calls, count(*) FILTER (WHERE is_handled) AS handled_calls,
        count(DISTINCT date) AS days_with_calls FROM curated GROUP BY queue_id),
headline AS (
  SELECT d.queue_id, coalesce(a.total_calls, 0) AS total_calls, coalesce(a.handled_calls, 0) AS handled_calls,
    coalesce(a.total_calls, 0) - coalesce(a.handled_calls, 0) AS no_agent_calls,
    {O.ratio('coalesce(a.handled_calls, 0)', 'coalesce(a.total_calls, 0)')} AS answer_rate,
    {O.ratio('coalesce(a.total_calls, 0) - coalesce(a.handled_calls, 0)', 'coalesce(a.total_calls, 0)')} AS no_agent_rate,
    coalesce(a.days_with_calls, 0) AS days_with_calls,
    {O.ratio('coalesce(a.total_calls, 0)', 'coalesce(a.days_with_calls, 0)')} AS avg_calls_per_active_day
  FROM {O.DIM} d LEFT JOIN agg a USING (queue_id))"""

@register("headline", O.with_curated(HEADLINE_SQL + "\nSELECT * FROM headline"))
def headline(spark, sf_dir):
    """A-1: totals, handled, no-agent and rates per queue (zero row for idle queues)."""
    return C.headline(ctx.cube(spark, sf_dir), ctx.dim(spark))


@register("active_days", O.with_curated(HEADLINE_SQL + "\nSELECT queue_id, days_with_calls, avg_calls_per_active_day FROM headline"))
def active_days(spark, sf_dir):
    """A-2: distinct call dates and average calls per active day."""
    return C.headline(ctx.cube(spark, sf_dir), ctx.dim(spark)).select(
        "queue_id", "days_with_calls", "avg_calls_per_active_day")


@register("daily_volume", O.with_curated("SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY queue_id, date"), dates=("date",))
def daily_volume(spark, sf_dir):
    """A-3 (= A-16, the same-day series)."""
    return C.daily_volume(ctx.cube(spark, sf_dir))


@register("weekly_volume", O.with_curated(
    "SELECT queue_id, CAST(date_trunc('week', date) AS DATE) AS week_start, "
    "CAST(date_trunc('week', date) AS DATE) + 6 AS week_end, count(*) AS calls FROM curated GROUP BY 1, 2"), dates=("week_start", "week_end"))
def weekly_volume(spark, sf_dir):
    """A-4: Monday..Sunday weeks."""
    return C.weekly_volume(ctx.cube(spark, sf_dir))


HOURLY_SQL = f"""SELECT queue_id, hour, count(call_id) AS calls, count(*) FILTER (WHERE NOT is_handled) AS no_answer_count,
  {O.ratio('count(*) FILTER (WHERE NOT is_handled)', 'count(call_id)')} AS no_answer_rate,
  avg(CASE WHEN is_handled THEN agent_sec END) AS avg_agent_sec
FROM curated GROUP BY queue_id, hour"""


@register("hourly_volume", O.with_curated(HOURLY_SQL))
def hourly_volume(spark, sf_dir):
    """A-5: calls, no-answer count/rate and mean handled agent seconds per hour."""
    return C.hourly_volume(ctx.cube(spark, sf_dir))


@register("dow_volume", O.with_curated("SELECT queue_id, dow, count(*) AS calls FROM curated GROUP BY queue_id, dow"))
def dow_volume(spark, sf_dir):
    """A-6."""
    return C.dow_volume(ctx.cube(spark, sf_dir))


@register("busiest_quietest_day", O.with_curated("""
, daily AS (SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY queue_id, date)
SELECT queue_id,
  arg_max(date, calls * 100000 - (date - DATE '1970-01-01')) AS busiest_date, max(calls) AS busiest_calls,
  arg_min(date, calls * 100000 + (date - DATE '1970-01-01')) AS quietest_date, min(calls) AS quietest_calls
FROM daily GROUP BY queue_id"""), dates=("busiest_date", "quietest_date"))
def busiest_quietest_day(spark, sf_dir):
    """A-21: ties go to the earliest date."""
    return C.busiest_quietest_day(ctx.cube(spark, sf_dir))


# --- flagship: headline joined with the funnel of the queue's language ------------------

FUNNEL_SQL = f""",
fb AS (
  SELECT language,
    count(*) FILTER (WHERE role = 'primary') AS primary_calls,
    count(*) FILTER (WHERE role = 'primary' AND is_handled) AS primary_answered,
    count(*) FILTER (WHERE role = 'overflow') AS overflow_received,
    count(*) FILTER (WHERE role = 'overflow' AND is_handled) AS overflow_answered
  FROM curated GROUP BY language),
fb2 AS (
  SELECT l.language, coalesce(primary_calls, 0) AS pc, coalesce(primary_answered, 0) AS pa,
    coalesce(overflow_received, 0) AS orc, coalesce(overflow_answered, 0) AS oa
  FROM (SELECT DISTINCT language FROM {O.DIM}) l LEFT JOIN fb USING (language)),
fb3 AS (SELECT *, pc - pa AS pf, orc - oa AS ofl, (orc > 0 OR pc - pa = 0) AS avail FROM fb2),
funnel AS (
  SELECT language, pc AS primary_calls, pa AS primary_answered, pf AS primary_failed, pf AS primary_no_agent_calls,
    {O.ratio('pf', 'pc')} AS primary_no_agent_rate, orc AS overflow_received, {O.ratio('orc', 'pf')} AS routing_match,
    oa AS overflow_answered, ofl AS overflow_failed,
    CASE WHEN avail THEN ofl ELSE pf END AS lost,
    {O.ratio('CASE WHEN avail THEN ofl ELSE pf END', 'pc')} AS lost_rate,
    CASE WHEN pc <> 0 THEN 1.0 - {O.ratio('CASE WHEN avail THEN ofl ELSE pf END', 'pc')} ELSE 0.0 END AS effective_answer_rate,
    pf - orc AS unaccounted, avail AS final_dropped_available,
    CASE WHEN avail THEN ofl END AS final_dropped_calls,
    CASE WHEN avail THEN 'final_dropped_after_overflow'
         ELSE 'primary_no_agent_handoff_candidates_overflow_missing' END AS drop_definition
  FROM fb3)"""


@register("language_funnel", O.with_curated(FUNNEL_SQL + "\nSELECT * FROM funnel"))
def language_funnel_q(spark, sf_dir):
    """A-11: primary -> overflow funnel per language."""
    return language_funnel(ctx.cube(spark, sf_dir), ctx.dim(spark))


FLAGSHIP_SQL = O.with_curated(HEADLINE_SQL + FUNNEL_SQL + f"""
SELECT h.*, d.language, d.role, f.primary_calls, f.primary_answered, f.overflow_received, f.overflow_answered,
  f.lost, f.effective_answer_rate, f.routing_match
FROM headline h JOIN {O.DIM} d USING (queue_id) JOIN funnel f USING (language)""")


def flagship_from(cube, dim):
    """Headline per queue next to the funnel of its language (A-1 ⟕ A-11)."""
    head = C.headline(cube, dim)
    fun = language_funnel(cube, dim).select(
        "language", "primary_calls", "primary_answered", "overflow_received", "overflow_answered",
        "lost", "effective_answer_rate", "routing_match")
    return (head.join(F.broadcast(dim.select("queue_id", "language", "role")), "queue_id")
            .join(fun, "language").select(*head.columns, "language", "role", *fun.columns[1:]))


@register("flagship", FLAGSHIP_SQL)
def flagship(spark, sf_dir):
    cube = ctx.cube_shared(spark, sf_dir)
    return flagship_from(cube, ctx.dim(spark))

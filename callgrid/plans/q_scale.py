"""Query family on ``lineitem`` legs: the same CSV pipeline over the largest driver table.

Call key ``l_orderkey`` per queue, keep-last over the full ordering list (the pair
``(l_orderkey, l_linenumber)`` is not unique); ship dates carry no time of day, so only
daily-grain metrics are meaningful here.
"""

from __future__ import annotations

from callgrid import oracle as O
from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.operators.curate import csv_pipeline
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.sources.testdata import lineitem_to_legs

LI_CURATED = f"""WITH li AS (
  SELECT *, CASE l_suppkey % 4 WHEN 0 THEN '8020' WHEN 1 THEN '8021' WHEN 2 THEN '8030' ELSE '8031' END AS queue_id
  FROM lineitem),
legs AS (
  SELECT li.*, 'o' || CAST(l_orderkey AS VARCHAR) AS orig_call_id,
    strftime(l_shipdate, '%m/%d/%Y %-I:%M %p') AS call_time,
    CASE WHEN l_partkey % 17 = 0 THEN 'Restricted'
         ELSE '+1 (416) 55' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(5, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') END AS caller_number,
    CASE WHEN l_returnflag = 'R' THEN '00:00'
         ELSE lpad(CAST(CAST(l_quantity * 7 AS BIGINT) // 60 AS VARCHAR), 2, '0') || ':' ||
              lpad(CAST(CAST(l_quantity * 7 AS BIGINT) % 60 AS VARCHAR), 2, '0') END AS agent_time,
    '00:' || lpad(CAST(l_linenumber * 7 % 60 AS VARCHAR), 2, '0') AS time_in_queue,
    CASE WHEN l_discount > 0.05 THEN '00:30' ELSE '00:00' END AS hold_time,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'Agent ' || CAST(l_suppkey % 40 AS VARCHAR) END AS agent_name
  FROM li),
deduped AS (
  SELECT * FROM legs QUALIFY row_number() OVER (PARTITION BY queue_id, orig_call_id
    ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC, l_quantity DESC,
             l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1),
curated AS (
  SELECT d.queue_id, q.language, q.role, orig_call_id AS call_id,
    CAST(strptime(call_time, '%m/%d/%Y %I:%M %p') AS DATE) AS date,
    {O.normalize_caller('caller_number', 'orig_call_id')} AS caller_number_norm, agent_name,
    {O.to_seconds('time_in_queue')} AS queue_sec, {O.to_seconds('agent_time')} AS agent_sec,
    {O.to_seconds('hold_time')} AS hold_sec,
    coalesce({O.to_seconds('agent_time')}, 0) > 0 AS is_handled
  FROM deduped d JOIN {O.DIM} q USING (queue_id))"""


def _curated(spark, sf_dir):
    return csv_pipeline(lineitem_to_legs(spark, sf_dir), None, None)  # the whole table: no period bounds


@register("lineitem_headline", LI_CURATED + f""",
agg AS (SELECT queue_id, count(*) AS total_calls, count(*) FILTER (WHERE is_handled) AS handled_calls,
        count(DISTINCT date) AS days_with_calls FROM curated GROUP BY queue_id)
SELECT d.queue_id, coalesce(a.total_calls, 0) AS total_calls, coalesce(a.handled_calls, 0) AS handled_calls,
  coalesce(a.total_calls, 0) - coalesce(a.handled_calls, 0) AS no_agent_calls,
  {O.ratio('coalesce(a.handled_calls, 0)', 'coalesce(a.total_calls, 0)')} AS answer_rate,
  {O.ratio('coalesce(a.total_calls, 0) - coalesce(a.handled_calls, 0)', 'coalesce(a.total_calls, 0)')} AS no_agent_rate,
  coalesce(a.days_with_calls, 0) AS days_with_calls,
  {O.ratio('coalesce(a.total_calls, 0)', 'coalesce(a.days_with_calls, 0)')} AS avg_calls_per_active_day
FROM {O.DIM} d LEFT JOIN agg a USING (queue_id)""")
def lineitem_headline(spark, sf_dir):
    """A-1/A-2 over lineitem legs (keep-last per queue + order key)."""
    return C.headline(C.calls_cube(_curated(spark, sf_dir)), ctx.dim(spark))


@register("lineitem_distribution", LI_CURATED + f""",
long AS (
  SELECT queue_id, 'queue_sec' AS measure, queue_sec AS value FROM curated WHERE queue_sec IS NOT NULL
  UNION ALL
  SELECT queue_id, 'agent_sec', agent_sec FROM curated
  WHERE is_handled AND coalesce({O.has_value('agent_name')}, false) AND agent_sec IS NOT NULL
  UNION ALL
  SELECT queue_id, 'hold_sec', hold_sec FROM curated WHERE coalesce(hold_sec, 0) > 0)
SELECT queue_id, measure, count(value) AS count, avg(value) AS mean,
  CASE WHEN count(value) > 1 THEN round(stddev_samp(value), 6) END AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS p75,
  max(value) AS max
FROM long GROUP BY queue_id, measure""")
def lineitem_distribution(spark, sf_dir):
    """A-7 over lineitem legs (exact percentiles on integral seconds)."""
    from pyspark.sql import functions as F
    d = M.duration_distribution(_curated(spark, sf_dir), ctx.dim(spark))
    return d.withColumn("std", F.round("std", 6))

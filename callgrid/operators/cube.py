"""Additive call cube and its roll-ups (A-1…A-6, A-15, A-16, A-21, X-2).

The curated table is scanned once into ``[queue, language, role, date, hour]``
counters; every volume metric below is a roll-up of that cube. The cube has at
most queues × days × 24 rows whatever the call volume, so the only shuffle that
sees raw rows is the cube's own, and it is map-side combined (partial
HashAggregate) — a queue holding a third of all calls costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrid.functions.exprs import safe_ratio, week_start
from callgrid.operators.curate import with_handled

CUBE_KEYS = ("queue_id", "language", "role", "date", "hour", "dow")


def calls_cube(curated: DataFrame) -> DataFrame:
    """Pre-aggregate curated calls to the additive grain.

    Group keys must be non-null (pandas drops null keys, T9); row counts and non-null
    call-id counts are both kept because different metrics use different ones.
    """
    c = with_handled(curated)
    h = F.col("is_handled")
    return (c.filter(F.col("queue_id").isNotNull())
             .groupBy(*CUBE_KEYS)
             .agg(F.count(F.lit(1)).alias("rows"),
                  F.count("call_id").alias("ids"),
                  F.count_if(h).alias("handled"),
                  F.count_if(~h).alias("not_handled"),
                  F.sum(F.when(h, F.col("agent_sec"))).alias("handled_sec_sum"),
                  F.count(F.when(h, F.col("agent_sec"))).alias("handled_sec_n")))


def headline(cube: DataFrame, dim: DataFrame) -> DataFrame:
    """A-1 + A-2 per queue; queues without calls get a zero row (left join from the dimension)."""
    per_q = cube.groupBy("queue_id").agg(
        F.sum("rows").alias("total_calls"),
        F.sum("handled").alias("handled_calls"),
        F.count_distinct(F.when(F.col("date").isNotNull(), F.col("date"))).alias("days_with_calls"),
    )
    out = (F.broadcast(dim.select("queue_id")).join(per_q, "queue_id", "left")
           .select("queue_id",
                   F.coalesce("total_calls", F.lit(0)).cast("bigint").alias("total_calls"),
                   F.coalesce("handled_calls", F.lit(0)).cast("bigint").alias("handled_calls"),
                   F.coalesce("days_with_calls", F.lit(0)).cast("bigint").alias("days_with_calls")))
    return out.select(
        "queue_id", "total_calls", "handled_calls",
        (F.col("total_calls") - F.col("handled_calls")).alias("no_agent_calls"),
        safe_ratio("handled_calls", "total_calls").alias("answer_rate"),
        safe_ratio(F.col("total_calls") - F.col("handled_calls"), "total_calls").alias("no_agent_rate"),
        "days_with_calls",
        safe_ratio("total_calls", "days_with_calls").alias("avg_calls_per_active_day"),
    )


def daily_volume(cube: DataFrame, *, with_no_answer: bool = False) -> DataFrame:
    """A-3 / A-16 (and X-2 with ``with_no_answer``): calls per queue and date."""
    aggs = [F.sum("rows").alias("calls")]
    if with_no_answer:
        aggs.append(F.sum("not_handled").alias("no_answer_count"))
    out = cube.filter(F.col("date").isNotNull()).groupBy("queue_id", "date").agg(*aggs)
    if with_no_answer:
        out = out.withColumn("no_answer_rate", safe_ratio("no_answer_count", "calls"))
    return out


def weekly_volume(cube: DataFrame) -> DataFrame:
    """A-4: Monday..Sunday weeks."""
    ws = week_start("date")
    return (cube.filter(F.col("date").isNotNull())
            .groupBy("queue_id", ws.alias("week_start"))
            .agg(F.sum("rows").alias("calls"))
            .select("queue_id", "week_start", F.date_add("week_start", 6).alias("week_end"), "calls"))


def hourly_volume(cube: DataFrame, *, with_avg: bool = True) -> DataFrame:
    """A-5 (and A-15 without the average): calls = non-null call ids, no-answer count/rate."""
    aggs = [F.sum("ids").alias("calls"), F.sum("not_handled").alias("no_answer_count")]
    if with_avg:
        aggs += [F.sum("handled_sec_sum").alias("_s"), F.sum("handled_sec_n").alias("_n")]
    out = cube.filter(F.col("hour").isNotNull()).groupBy("queue_id", "hour").agg(*aggs)
    out = out.withColumn("no_answer_rate", safe_ratio("no_answer_count", "calls"))
    if with_avg:
        out = out.withColumn("avg_agent_sec", F.try_divide("_s", "_n")).drop("_s", "_n")
    return out


def dow_volume(cube: DataFrame) -> DataFrame:
    """A-6: calls per queue and weekday name."""
    return cube.filter(F.col("dow").isNotNull()).groupBy("queue_id", "dow").agg(F.sum("rows").alias("calls"))


def busiest_quietest_day(cube: DataFrame) -> DataFrame:
    """A-21: busiest (calls desc, earliest date) and quietest (calls asc, earliest date) per queue."""
    daily = daily_volume(cube)
    return daily.groupBy("queue_id").agg(
        F.max_by("date", F.struct(F.col("calls"), -F.unix_date("date"))).alias("busiest_date"),
        F.max("calls").alias("busiest_calls"),
        F.min_by("date", F.struct(F.col("calls"), F.unix_date("date"))).alias("quietest_date"),
        F.min("calls").alias("quietest_calls"),
    )

"""Cross-queue operators: language funnel (A-11, X-1), consolidated pivots (A-12, A-13),
multi-queue callers (P-16), funnel slices (P-17), overlays (J-9, J-10, W-4).

Primary/overflow pairing (J-6) is conditional aggregation on (language, role) taken
from the queue dimension, so any number of languages works and no self-join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callgrid.functions.exprs import is_restricted, safe_ratio
from callgrid.operators.curate import with_handled

# Drop-definition labels of the funnel.
DROP_AFTER_OVERFLOW = "final_dropped_after_overflow"
DROP_OVERFLOW_MISSING = "primary_no_agent_handoff_candidates_overflow_missing"

FUNNEL_COLUMNS = ("primary_calls", "primary_answered", "primary_failed", "primary_no_agent_calls",
                  "primary_no_agent_rate", "overflow_received", "routing_match", "overflow_answered",
                  "overflow_failed", "lost", "lost_rate", "effective_answer_rate", "unaccounted",
                  "final_dropped_available", "final_dropped_calls", "drop_definition")


def funnel_measures(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Derive the 16 funnel measures from the four base counts (calls-based ``lost``, T12)."""
    pc, pa = F.col("primary_calls"), F.col("primary_answered")
    orc, oa = F.col("overflow_received"), F.col("overflow_answered")
    pf = pc - pa
    of = orc - oa
    available = (orc > 0) | (pf == 0)
    lost = F.when(available, of).otherwise(pf)
    return df.select(
        *keys,
        pc.alias("primary_calls"), pa.alias("primary_answered"),
        pf.alias("primary_failed"), pf.alias("primary_no_agent_calls"),
        safe_ratio(pf, pc).alias("primary_no_agent_rate"),
        orc.alias("overflow_received"),
        safe_ratio(orc, pf).alias("routing_match"),
        oa.alias("overflow_answered"), of.alias("overflow_failed"),
        lost.alias("lost"),
        safe_ratio(lost, pc).alias("lost_rate"),
        F.when(pc != 0, F.lit(1.0) - safe_ratio(lost, pc)).otherwise(F.lit(0.0)).alias("effective_answer_rate"),
        (pf - orc).alias("unaccounted"),
        available.alias("final_dropped_available"),
        F.when(available, of).alias("final_dropped_calls"),
        F.when(available, F.lit(DROP_AFTER_OVERFLOW)).otherwise(F.lit(DROP_OVERFLOW_MISSING)).alias("drop_definition"),
    )


def _base_counts(cube: DataFrame, keys: Sequence[str]) -> DataFrame:
    prim = F.col("role") == "primary"
    ovf = F.col("role") == "overflow"
    return cube.groupBy(*keys).agg(
        F.sum(F.when(prim, F.col("rows")).otherwise(0)).alias("primary_calls"),
        F.sum(F.when(prim, F.col("handled")).otherwise(0)).alias("primary_answered"),
        F.sum(F.when(ovf, F.col("rows")).otherwise(0)).alias("overflow_received"),
        F.sum(F.when(ovf, F.col("handled")).otherwise(0)).alias("overflow_answered"),
    )


def language_funnel(cube: DataFrame, dim: DataFrame) -> DataFrame:
    """A-11: one funnel per language of the dimension (zeros when a language has no calls)."""
    counts = _base_counts(cube.filter(F.col("language").isNotNull()), ["language"])
    langs = dim.select("language").distinct()
    base = F.broadcast(langs).join(counts, "language", "left").select(
        "language", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                      for c in ("primary_calls", "primary_answered", "overflow_received", "overflow_answered")])
    return funnel_measures(base, ["language"])


def effective_rate_daily(cube: DataFrame) -> DataFrame:
    """X-1: the funnel per (language, date)."""
    counts = _base_counts(cube.filter(F.col("language").isNotNull() & F.col("date").isNotNull()),
                          ["language", "date"])
    return funnel_measures(counts, ["language", "date"])


def funnel_slices(funnel: DataFrame) -> DataFrame:
    """P-17: the chart slices of each funnel, positive values only."""
    long = funnel.select(
        "language",
        F.stack(F.lit(4),
                F.lit("answered_primary"), F.col("primary_answered"),
                F.lit("answered_overflow"), F.col("overflow_answered"),
                F.lit("never_connected"), F.col("lost"),
                F.lit("untracked"), F.col("unaccounted")).alias("slice", "value"))
    return long.filter(F.col("value") > 0)


def pivot_by_queue(df: DataFrame, key: str, ids: Sequence[str]) -> DataFrame:
    out = df.groupBy(key).pivot("queue_id", list(ids)).agg(F.count("call_id")).na.fill(0, subset=list(ids))
    total = sum((F.col(f"`{q}`") for q in ids), F.lit(0))
    return out.withColumn("total_calls", total.cast("bigint"))


def consolidated_agents(curated: DataFrame, ids: Sequence[str]) -> DataFrame:
    """A-12: handled calls per agent pivoted by queue + total (agent only needs to be non-null)."""
    c = with_handled(curated)
    src = c.filter(F.col("is_handled") & F.col("agent_name").isNotNull() & F.col("queue_id").isin(*ids))
    return pivot_by_queue(src, "agent_name", ids)


def consolidated_callers(curated: DataFrame, ids: Sequence[str]) -> DataFrame:
    """A-13: calls per caller pivoted by queue + total; restricted callers excluded (P-9)."""
    src = curated.filter(F.col("caller_number_norm").isNotNull() & ~is_restricted("caller_number_norm")
                         & F.col("queue_id").isin(*ids))
    return pivot_by_queue(src, "caller_number_norm", ids)


def multi_queue_callers(callers: DataFrame, ids: Sequence[str]) -> DataFrame:
    """P-16: callers seen on at least two queues."""
    seen = F.size(F.filter(F.array(*[F.col(f"`{q}`") for q in ids]), lambda x: x > 0))
    return callers.filter(seen >= 2)


def same_hour_grid(hourly: DataFrame, dim: DataFrame) -> DataFrame:
    """J-9: dense 24-hour grid per queue, no-answer rate 0 where a queue had no call in that hour."""
    grid = dim.select("queue_id", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return (grid.join(hourly.select("queue_id", "hour", "no_answer_rate"), ["queue_id", "hour"], "left")
            .select("queue_id", "hour", F.coalesce("no_answer_rate", F.lit(0.0)).alias("no_answer_rate")))


def same_day_pivot(daily: DataFrame, ids: Sequence[str]) -> DataFrame:
    """J-10: date x queue calls for the overlay chart (missing = null, as the chart leaves it)."""
    return daily.groupBy("date").pivot("queue_id", list(ids)).agg(F.sum("calls"))


def same_day_normalized(daily: DataFrame) -> DataFrame:
    """W-4: each day's calls as a share of the queue's own maximum day; 0 when that maximum is 0.

    The window runs over aggregated (queue, date) rows, bounded by the period's days.
    """
    mx = F.max("calls").over(Window.partitionBy("queue_id"))
    return daily.select("queue_id", "date",
                        F.when(mx > 0, F.col("calls") / mx).otherwise(F.lit(0.0)).alias("normalized_calls"))

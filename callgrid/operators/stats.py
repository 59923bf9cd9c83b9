"""Source-supplied queue statistics: scan (S-5), per-queue diagnostics (A-23, J-4) and the
statistics funnel per language (A-24, with its own ``lost`` formula, T12).

Primary/overflow pairs come from the queue dimension by (language, role), not from
hard-coded ids (T13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrid.functions.exprs import loose_int, safe_ratio
from callgrid.operators.cross import DROP_AFTER_OVERFLOW

STAT_FIELDS = ("calls_offered", "calls_forwarded", "abandoned_calls", "calls_handled", "call_volume")
STATS_NOTE = "Diagnostic only; cleaned queue metrics are not overwritten."
STATS_JSON_SCHEMA = "map<string, map<string, string>>"


def parse_stats(doc: DataFrame, column: str = "value") -> DataFrame:
    """S-5: a JSON object keyed by queue id -> one row per queue with loose integers (F-14).

    Values are read as text so numbers, numeric strings and nulls all pass through F-14.
    A document that is not an object fails the job.
    """
    parsed = F.from_json(F.col(column), STATS_JSON_SCHEMA)
    checked = F.when(parsed.isNull(), F.raise_error(F.lit("queue statistics must be a JSON object"))).otherwise(parsed)
    rows = doc.select(F.explode(checked).alias("queue_id", "s"))
    return rows.select("queue_id", *[loose_int(F.col("s")[f]).alias(f) for f in STAT_FIELDS])


def stats_diagnostics(stats: DataFrame, dim: DataFrame) -> DataFrame:
    """A-23: derived no-agent = min(offered, forwarded + abandoned), handled = max(0, offered - no-agent)."""
    no_agent = F.least("calls_offered", F.col("calls_forwarded") + F.col("abandoned_calls"))
    return (stats.join(F.broadcast(dim.select("queue_id")), "queue_id")
            .select("queue_id", *STAT_FIELDS, no_agent.alias("derived_no_agent_calls"),
                    F.greatest(F.lit(0), F.col("calls_offered") - no_agent).cast("bigint").alias("derived_handled_calls"),
                    F.lit(STATS_NOTE).alias("note")))


def stats_funnel(stats: DataFrame, dim: DataFrame) -> DataFrame:
    """A-24: funnel per language from the statistics; missing queue stats count as zeros."""
    s = F.broadcast(dim.select("queue_id", "language", "role")).join(stats, "queue_id", "left")

    def pick(role: str, field: str):
        return F.coalesce(F.sum(F.when(F.col("role") == role, F.col(field))), F.lit(0)).cast("bigint")

    base = s.groupBy("language").agg(
        pick("primary", "calls_offered").alias("p_off"),
        (pick("primary", "calls_forwarded") + pick("primary", "abandoned_calls")).alias("p_lost"),
        pick("overflow", "calls_offered").alias("o_off"),
        (pick("overflow", "calls_forwarded") + pick("overflow", "abandoned_calls")).alias("o_lost"),
    )
    pc, orc = F.col("p_off"), F.col("o_off")
    pf = F.least(pc, F.col("p_lost"))
    of = F.least(orc, F.col("o_lost"))
    pa = F.greatest(F.lit(0), pc - pf)
    oa = F.greatest(F.lit(0), orc - of)
    lost = F.greatest(F.lit(0), pf - oa)
    return base.select(
        "language", pc.alias("primary_calls"), pa.cast("bigint").alias("primary_answered"),
        pf.alias("primary_failed"), pf.alias("primary_no_agent_calls"),
        safe_ratio(pf, pc).alias("primary_no_agent_rate"), orc.alias("overflow_received"),
        safe_ratio(orc, pf).alias("routing_match"), oa.cast("bigint").alias("overflow_answered"),
        of.alias("overflow_failed"), lost.cast("bigint").alias("lost"),
        safe_ratio(lost, pc).alias("lost_rate"),
        F.when(pc != 0, F.lit(1.0) - safe_ratio(lost, pc)).otherwise(F.lit(0.0)).alias("effective_answer_rate"),
        (pf - orc).alias("unaccounted"), F.lit(True).alias("final_dropped_available"),
        lost.cast("bigint").alias("final_dropped_calls"), F.lit(DROP_AFTER_OVERFLOW).alias("drop_definition"),
    )


def stats_document_from_legs(legs: DataFrame) -> DataFrame:
    """Synthesize the source's statistics document (one JSON object keyed by queue id) from legs.

    offered = legs, forwarded = "No Answer" legs, abandoned = "Abandoned" legs,
    handled = legs with talk time, volume = distinct calls. The per-queue aggregate
    is bounded by the number of queues, so gathering it into one document is safe.
    """
    reason = F.lower(F.trim("queue_release_reason"))
    per_q = legs.groupBy("queue_id").agg(
        F.count(F.lit(1)).alias("calls_offered"),
        F.count_if(reason == "no answer").alias("calls_forwarded"),
        F.count_if(reason == "abandoned").alias("abandoned_calls"),
        F.count_if(~F.col("agent_time").isin("00:00", "53ms")).alias("calls_handled"),
        F.count_distinct("orig_call_id").alias("call_volume"))
    entry = F.struct(F.col("queue_id").alias("key"),
                     F.create_map(*[x for f in STAT_FIELDS for x in (F.lit(f), F.col(f).cast("string"))]).alias("value"))
    return per_q.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))

"""Rule-based anomalies (N-1…N-5) over metric tables; all thresholds are strict ``>``.

Inputs are the aggregated leaderboard (A-9), hourly (A-5) and consolidated caller
(A-13) tables, so the rules never touch raw calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.functions.exprs import loose_float, non_human_agent

# Severities, kinds, views and description formats of the anomaly rows.
SYSTEM_AGENT_TEXT = "%s appears in queue %s agent leaderboard and should be verified as human or system."
SINGLE_AGENT_TEXT = "%s handled more than 60%% of answered calls on queue %s."
HOURLY_TEXT = "Queue %s has no-answer rate above 50%% at %s:00."
CALLER_TEXT = "Caller %s exceeded %d cross-queue contacts."
SINGLE_AGENT_SHARE = 0.60
HOURLY_NO_ANSWER_RATE = 0.50
CALLER_THRESHOLD = 20

ANOMALY_COLUMNS = ("severity", "kind", "queue_id", "description", "target_json", "rule_order", "item_order")


def _rows(df: DataFrame, severity: str, kind: str, queue_id: Column | None, description: Column,
          view: str, agent: Column | None = None, hour: Column | None = None,
          entity: Column | None = None, rule_order: int = 0, item_order: Column | None = None) -> DataFrame:
    null_s = F.lit(None).cast("string")
    # the target object carries only the keys of its kind (nulls are left out of the JSON)
    target = F.struct(F.lit(view).alias("view"),
                      (queue_id if queue_id is not None else null_s).alias("queue_id"),
                      (agent if agent is not None else null_s).alias("agent_name"),
                      (hour if hour is not None else F.lit(None).cast("int")).alias("hour"),
                      (entity if entity is not None else null_s).alias("entity"))
    return df.select(
        F.lit(severity).alias("severity"), F.lit(kind).alias("kind"),
        (queue_id if queue_id is not None else null_s).alias("queue_id"),
        description.alias("description"),
        F.to_json(target).alias("target_json"),
        F.lit(rule_order).alias("rule_order"),
        (item_order if item_order is not None else F.lit(0)).cast("bigint").alias("item_order"),
    )


def _named(leaderboard: DataFrame) -> DataFrame:
    # N-5: rows without a name never raise an anomaly
    return leaderboard.filter(F.col("agent_name").isNotNull() & (F.col("agent_name") != ""))


def system_agent(leaderboard: DataFrame) -> DataFrame:
    """N-1: a leaderboard name that looks non-human (F-19)."""
    src = _named(leaderboard).filter(non_human_agent("agent_name"))
    return _rows(src, "high", "system_agent", F.col("queue_id"),
                 F.format_string(SYSTEM_AGENT_TEXT, F.col("agent_name"), F.col("queue_id")),
                 "per-queue", agent=F.col("agent_name"), rule_order=0, item_order=F.col("rank") * 2)


def single_agent_dependency(leaderboard: DataFrame, share: float = SINGLE_AGENT_SHARE) -> DataFrame:
    """N-2: one agent took more than 60 % of a queue's answered calls (bad share -> 0)."""
    src = _named(leaderboard).filter(loose_float("pct_of_answered") > share)
    return _rows(src, "high", "single_agent_dependency", F.col("queue_id"),
                 F.format_string(SINGLE_AGENT_TEXT, F.col("agent_name"), F.col("queue_id")),
                 "per-queue", agent=F.col("agent_name"), rule_order=0, item_order=F.col("rank") * 2 + 1)


def hourly_no_answer(hourly: DataFrame, rate: float = HOURLY_NO_ANSWER_RATE) -> DataFrame:
    """N-3: an hour whose no-answer rate is above 50 %."""
    src = hourly.filter(F.col("hour").isNotNull() & (loose_float("no_answer_rate") > rate))
    return _rows(src, "medium", "hourly_no_answer", F.col("queue_id"),
                 F.format_string(HOURLY_TEXT, F.col("queue_id"), F.lpad(F.col("hour").cast("string"), 2, "0")),
                 "per-queue", hour=F.col("hour").cast("int"), rule_order=1, item_order=F.col("hour"))


def caller_concentration(callers: DataFrame, threshold: int = CALLER_THRESHOLD) -> DataFrame:
    """N-4: a caller with more than ``threshold`` contacts across queues."""
    src = callers.filter(F.col("caller_number_norm").isNotNull() & (F.col("caller_number_norm") != "")
                         & (F.col("total_calls") > threshold))
    return _rows(src, "medium", "caller_concentration", None,
                 F.format_string(CALLER_TEXT, F.col("caller_number_norm"), F.lit(threshold)),
                 "cross-queue", entity=F.col("caller_number_norm"), rule_order=2,
                 item_order=F.lit(0))


def all_anomalies(leaderboard: DataFrame, hourly: DataFrame, callers: DataFrame,
                  caller_threshold: int = CALLER_THRESHOLD) -> DataFrame:
    """Union of N-1…N-4; ``rule_order``/``item_order`` keep the emission order
    (per queue: agents, then hours; callers last)."""
    return (system_agent(leaderboard)
            .unionByName(single_agent_dependency(leaderboard))
            .unionByName(hourly_no_answer(hourly))
            .unionByName(caller_concentration(callers, caller_threshold)))
